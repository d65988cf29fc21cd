"""Secrets in texts: fixed patterns, and a battery of randomness tests on everything that looks encoded.

DataFrame functions only; per document everything stays inside its row, so nothing is shuffled but one small histogram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.text import documents, let, match_spans, outermost, saved

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")  # every match of ASSIGN holds one of them, in either case
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
ACCESS = r"AKIA[A-Z0-9]+"
HEX = rf"[0-9a-f]{{{HEX_LENGTH},}}"  # runs are maximal, so shorter ones need no dropping
SHORTEST = 20
ENCODED = rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}={{0,2}}"
# a run as a whole and its pieces between separators: a key may follow a prefix or stand in a path
RUNS = [ENCODED, *(rf"[A-Za-z0-9{inner}]{{{SHORTEST},}}={{0,2}}" for inner in ("+/", "_-", ""))]
KINDS = ("assign", "access", "hex", "random")

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# encoding: (texts it is inferred from, its alphabet, chance that two symbols of ordinary text in that alphabet agree)
ENCODINGS = {
    "hex": (r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", DIGITS + LOWER[:6], 0.115),
    "HEX": (r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", DIGITS + UPPER[:6], 0.115),
    "base32": (r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", UPPER + "234567", 0.065),
    "BASE36": (r"^(?=(?:[^0-9]*[0-9]){2})(?=.*[A-Z])[A-Z0-9]+$", UPPER + DIGITS, 0.06),
    "base36": (r"^(?=(?:[^0-9]*[0-9]){4})(?=.*[a-z])[a-z0-9]+$", LOWER + DIGITS, 0.06),
    "base62": (r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9]+$", UPPER + LOWER + DIGITS, 0.06),
    "base64": (r"^(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/]+=*$", UPPER + LOWER + DIGITS + "+/", 0.06),
    "base64url": (r"^(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9_-]+=*$", UPPER + LOWER + DIGITS + "-_", 0.06),
    "base38url": (r"^(?=(?:[^0-9]*[0-9]){4})(?=.*[a-z])[a-z0-9_-]+$", LOWER + DIGITS + "-_", 0.06),
}
REJECT = 1e-3  # a string is not random when the corrected smallest p-value of the battery is below
FDR = 0.05
GRID = 400  # p-values are ranked on a grid of tenths of a decade


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) / 2.5066282746310002 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * upper_tail(F.abs(z)))


def _encoding(token: Column) -> Column:
    """(name, alphabet, agreement) of the first encoding the whole string fits, null for none."""
    out = F.lit(None).cast("struct<name:string,alphabet:string,agree:double>")
    for name, (pattern, alphabet, agree) in reversed(ENCODINGS.items()):
        fits = F.struct(F.lit(name).alias("name"), F.lit(alphabet).alias("alphabet"), F.lit(agree).alias("agree"))
        out = F.when(token.rlike(pattern), fits).otherwise(out)
    return out


def battery(strings: Column) -> Column:
    """For an array of (start, end, token): those of an inferred encoding, with p_text and p_random.

    Symbols are numbered by their place in the alphabet of k. *Uniformity*: chi-squared of the symbol counts. *Runs*:
    Wald and Wolfowitz's test on upper against lower half of the alphabet. *Serial correlation*: lag one, of the numbers.
    p_random is the smallest of the three p-values under "drawn at random", times three. p_text is the chance that
    ordinary text of this length would look as even: its chi-squared grows with length by the agreement of two symbols,
    so a short string can't get a small one.
    """
    read = F.filter(F.transform(strings, lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), F.rtrim(s.token, F.lit("=")).alias("body"), _encoding(s.token).alias("enc"))), lambda s: s.enc.isNotNull())

    def counted(s: Column) -> Column:
        symbols = F.split(s.enc.alphabet, "")
        square = F.aggregate(
            F.transform(symbols, lambda c: (F.length(s.body) - F.length(F.replace(s.body, c, F.lit("")))).cast("double")),
            F.lit(0.0),
            lambda a, c: a + c * c,
        )
        places = F.transform(F.split(s.body, ""), lambda c: (F.instr(s.enc.alphabet, c) - 1).cast("double"))
        return F.struct(
            s.start.alias("start"), s.end.alias("end"), s.enc["name"].alias("enc"), s.enc.agree.alias("agree"),
            F.length(s.enc.alphabet).cast("double").alias("k"), F.length(s.body).cast("double").alias("n"), square.alias("square"), places.alias("x"),
        )

    def summed(s: Column) -> Column:
        mean = F.aggregate(s.x, F.lit(0.0), lambda a, x: a + x) / s.n
        follow = F.slice(s.x, F.lit(2), s.n.cast("int") - 1)
        pairs = F.zip_with(F.slice(s.x, F.lit(1), s.n.cast("int") - 1), follow, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        high = lambda v: (v >= s.k / 2).cast("double")
        return F.struct(
            s.start.alias("start"), s.end.alias("end"), s.enc.alias("enc"), s.agree.alias("agree"), s.k.alias("k"), s.n.alias("n"), s.square.alias("square"), mean.alias("mean"),
            F.aggregate(s.x, F.lit(0.0), lambda a, x: a + high(x)).alias("upper"),
            F.aggregate(pairs, F.lit(1.0), lambda a, p: a + F.abs(high(p.a) - high(p.b))).alias("runs"),
            pairs.alias("pairs"), s.x.alias("x"),
        )

    def tested(s: Column) -> Column:
        chi = s.k / s.n * s.square - s.n
        d = s.k - 1
        p_even = upper_tail((F.pow(F.greatest(chi, F.lit(0.0)) / d, F.lit(1 / 3)) - (1 - 2 / (9 * d))) / F.sqrt(2 / (9 * d)))
        expected = 2 * s.upper * (s.n - s.upper) / s.n + 1
        spread = (expected - 1) * (expected - 2) / (s.n - 1)
        p_runs = F.when(spread > 0, two_sided((s.runs - expected) / F.sqrt(spread))).otherwise(0.0)
        around = F.aggregate(s.x, F.lit(0.0), lambda a, x: a + (x - s["mean"]) * (x - s["mean"]))
        along = F.aggregate(s.pairs, F.lit(0.0), lambda a, p: a + (p.a - s["mean"]) * (p.b - s["mean"]))
        p_serial = F.when(around > 0, two_sided((along / around + 1 / s.n) * F.sqrt(s.n))).otherwise(0.0)
        text_chi = s.k * (1 + (s.n - 1) * s.agree) - s.n
        p_text = upper_tail((text_chi - chi) / (2 * F.sqrt(2 * d)))
        p_random = F.least(F.lit(1.0), 3 * F.least(p_even, p_runs, p_serial))
        return F.struct(s.start.alias("start"), s.end.alias("end"), s.enc.alias("enc"), p_text.alias("p_text"), p_random.alias("p_random"))

    return F.transform(F.transform(F.transform(read, counted), summed), tested)


def _level(s: Column) -> Column:
    """Place of a tested string on the grid: the higher, the less it is like text; 0 when it isn't random either."""
    decades = F.floor(-10 * F.log10(F.greatest(s.p_text, F.lit(1e-40)))).cast("int")
    return F.when(s.p_random >= REJECT, F.least(decades, F.lit(GRID))).otherwise(F.lit(0))


def discovery_level(tested: DataFrame, rate: float = FDR) -> int:
    """Lowest grid level at which Benjamini and Hochberg's rule holds over all strings of the table.

    A level stands for the largest p-value on it, which keeps the rule conservative. The counts are one row per level.
    """
    counts = tested.select(F.explode("tested").alias("s")).groupBy(_level(F.col("s")).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    grid = counts.agg(F.map_from_entries(F.collect_list(F.struct("level", "n"))).alias("n"))
    at = lambda v: F.coalesce(F.try_element_at(grid["n"], v), F.lit(0))
    total = F.aggregate(F.map_values(grid["n"]), F.lit(0).cast("bigint"), lambda a, n: a + n)
    start = F.struct(F.lit(0).cast("bigint").alias("above"), F.lit(GRID + 1).alias("lowest"))

    def step(acc: Column, level: Column) -> Column:
        above = acc.above + at(level)
        holds = (above > 0) & (F.pow(F.lit(10.0), -level / 10) * total <= rate * above)
        return F.struct(above.alias("above"), F.when(holds, level).otherwise(acc.lowest).alias("lowest"))

    levels = F.sequence(F.lit(GRID), F.lit(1), F.lit(-1))
    return grid.select(F.aggregate(levels, start, step, lambda a: a.lowest).alias("lowest")).first().lowest or GRID + 1


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FDR) -> DataFrame:
    """One row per row of `docs`: doc_id, base (array of kind, start, end) and found (base and random strings).

    Base spans: assignments to a secret's name with a value of 8 characters or more, access keys, runs of hex digits;
    leftmost and non-overlapping for each kind, in code points. Strings of 20 characters or more of an encoding's
    alphabet go through the battery, whole runs and their pieces between separators, and those that pass at a
    false-discovery rate of `rate` over the whole table are added with kind "random", but for pieces of others that
    pass. They may coincide with base spans, which stay. Letters of one case without a digit are not tested: words put
    together look as even at these lengths.

    Null and empty texts have no spans; repeated rows are judged each; an empty table gives an empty result; other
    columns are ignored. Regexes run only on texts that pass plain substring checks no match can fail.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lowered = F.lower("text")
    none = F.expr("CAST(array() AS array<struct<start:int,end:int>>)")
    named = lambda w: F.contains(F.col("lowered"), F.lit(w))
    gate = named(ASSIGN_WORDS[0])
    for w in ASSIGN_WORDS[1:]:
        gate = gate | named(w)
    assigned = F.filter(
        F.zip_with(
            match_spans(F.col("text"), ASSIGN),
            F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
            lambda s, v: F.struct(s.start.alias("start"), s.end.alias("end"), F.length(v).alias("size")),
        ),
        lambda s: s["size"] >= ASSIGN_LENGTH,
    )
    assigned = F.transform(assigned, lambda s: F.struct(s.start.alias("start"), s.end.alias("end")))
    access = F.filter(match_spans(F.col("text"), ACCESS), lambda s: s.end - s.start >= ACCESS_LENGTH)
    runs = [
        F.zip_with(
            match_spans(F.col("text"), run),
            F.regexp_extract_all("text", F.lit(run), F.lit(0)),
            lambda s, t: F.struct(s.start.alias("start"), s.end.alias("end"), t.alias("token")),
        )
        for run in RUNS
    ]
    # a string that several patterns find is there once; equal ones stand together after the sort
    different = lambda a, s, i: (i == 0) | (F.get(a, i - 1).start != s.start) | (F.get(a, i - 1).end != s.end)
    encoded = let(F.array_sort(F.concat(*runs)), lambda a: F.filter(a, lambda s, i: different(a, s, i)))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("lowered", lowered)
    rows = rows.select("doc_id", "text", gate.alias("named"), F.col("text").rlike(ENCODED).alias("encoded"))
    tested_none = F.expr("CAST(array() AS array<struct<start:int,end:int,enc:string,p_text:double,p_random:double>>)")
    rows = rows.select(
        "doc_id",
        F.when(F.col("named"), assigned).otherwise(none).alias("assign"),
        F.when(F.contains("text", F.lit("AKIA")), access).otherwise(none).alias("access"),
        F.when(F.col("encoded"), match_spans(F.col("text"), HEX)).otherwise(none).alias("hex"),
        F.when(F.col("encoded"), battery(encoded)).otherwise(tested_none).alias("tested"),
    )
    rows = saved(rows)
    level = discovery_level(rows, rate)
    rows = rows.withColumn("passed", F.filter("tested", lambda s: _level(s) >= level))
    passed = outermost(F.col("passed"))

    def tagged(kind: str, spans: Column | str) -> Column:
        return F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s.end.alias("end"), F.lit(kind).alias("kind")))

    base = F.concat(*[tagged(k, k) for k in KINDS[:3]])
    return rows.select(
        "doc_id", "assign", "access", "hex", "tested", F.array_sort(base).alias("base"), F.array_sort(F.concat(base, tagged("random", passed))).alias("found")
    )


def joined(spans: Column | str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(documents(spark, sf_dir))
    n = lambda c: F.size(c).cast("long")
    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("found").alias("spans"),
    )
