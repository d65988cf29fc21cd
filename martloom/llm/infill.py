"""Fill-in-the-middle: texts cut at two token boundaries and put together again with the middle last.

Boundaries are found eight bytes at a time: the UTF-8 of a batch is one array of 64-bit words, token ends become one bit a
byte, counts per word are summed up, and a wanted boundary is searched for in the sums and then selected inside its word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.text import documents

SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED = 50  # texts of 100 that are rearranged
SUFFIX_FIRST = 80  # of 100 rearranged ones, those that begin with the suffix


def _each(byte: int) -> np.uint64:
    return np.uint64(int.from_bytes(bytes([byte]) * 8, "little"))


ONE, HIGH, LOW7, ONES = _each(0x01), _each(0x80), _each(0x7F), np.uint64(0xFFFFFFFFFFFFFFFF)
TO_9, TO_14, BLANK = _each(0x80 - 9), _each(0x80 - 14), _each(0x20)
ONE_BIT, BYTE, TOP = np.uint64(1), np.uint64(8), np.uint64(56)


def spaces(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is a space or one of the controls 9 to 13. No sum passes into the next byte."""
    low = words & LOW7
    control = (low + TO_9) & ~(low + TO_14) & ~words
    other = words ^ BLANK
    blank = ~(((other & LOW7) + LOW7) | other)
    return (control | blank) & HIGH


def token_ends(words: np.ndarray, last_bytes: np.ndarray) -> np.ndarray:
    """The high bit of each byte that ends a token: one before a space, and the last one of every text.

    Spaces belong to the token after them; those at the end of a text are a token of their own.
    """
    space = spaces(words)
    following = space >> BYTE
    following[:-1] |= space[1:] << TOP
    ends = ~space & following & HIGH
    ends.view(np.uint8)[last_bytes] |= 0x80
    return ends


class Marks:
    """Counting and finding marked bytes by the number of marks in the words before."""

    def __init__(self, marks: np.ndarray) -> None:
        self.marks = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Marks on the bytes before a place."""
        word, byte = place >> 3, (place & 7).astype(np.uint64)
        inside = self.marks[np.minimum(word, len(self.marks) - 1)] & ~(ONES << (byte * BYTE))
        return self.before[word] + np.where(byte > 0, np.bitwise_count(inside), 0)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte of mark number k, from 0.

        Multiplying by ONE sums up the marks of a word byte by byte; the bytes whose sum does not pass k stand before.
        """
        word = np.searchsorted(self.before, k, side="right") - 1
        sums = (self.marks[word] >> np.uint64(7)) * ONE
        wanted = (k - self.before[word] + 1).astype(np.uint64) * ONE
        reached = ((sums | HIGH) - wanted) & HIGH
        return (word << 3) + 8 - np.bitwise_count(reached)


def cuts(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text and the code points of its prefix and its middle.

    `data` are the bytes of all texts one after the other, `offsets` where each begins, and the end. The prefix holds
    the smaller of h1 and h2, modulo tokens + 1, the middle goes on to the larger.
    """
    starts, stops = offsets[:-1], offsets[1:]
    if not len(data):
        none = np.zeros(len(starts), np.int64)
        return none, none, none
    padded = np.zeros(-(-len(data) // 8) * 8, np.uint8)
    padded[: len(data)] = data
    words = padded.view("<u8")
    ends = Marks(token_ends(words, stops[stops > starts] - 1))
    first = ends.rank(starts)
    n = ends.rank(stops) - first
    one, two = h1 % (n + 1), h2 % (n + 1)
    # a code point begins at each byte but those of the form 10xxxxxx
    points = Marks(~(words & ~(words << ONE_BIT)) & HIGH)

    def place(units: np.ndarray) -> np.ndarray:
        at = starts.copy()
        some = units > 0
        at[some] = ends.select(first[some] + units[some] - 1) + 1
        return at

    begin, p, m = points.rank(starts), points.rank(place(np.minimum(one, two))), points.rank(place(np.maximum(one, two)))
    return n, p - begin, m - p


CUTS = "n bigint, prefix_chars bigint, middle_chars bigint"


def cut_batches(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for text, h1, h2 in batches:
        wide = text.cast(pa.large_string()).fill_null("")  # offsets that a batch of very long texts does not outgrow
        _, bounds, body = wide.buffers()
        offsets = np.frombuffer(bounds, np.int64)[wide.offset : wide.offset + len(wide) + 1]
        data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body else np.zeros(0, np.uint8)
        found = cuts(data, offsets - offsets[0], h1.to_numpy(), h2.to_numpy())
        yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in found], names=["n", "prefix_chars", "middle_chars"])


def infill(
    docs: DataFrame, seed: int = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """`docs` with a struct `infill`: n (tokens), form, prefix_chars, middle_chars and the text put together anew.

    Form is `plain` (the text as it is, pieces null), `psm` (prefix, suffix, middle) or `spm` (suffix first); a hash of
    seed and doc_id decides, so reruns agree and rows of one id are treated alike. A null text counts as empty, a null
    id as the empty id. Empty texts, and those that hold a sentinel, are plain, so each sentinel of the others stands
    there once. A column of `docs` named infill is replaced, no other is touched; it needs doc_id and text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4))
    cut = F.arrow_udf(cut_batches, CUTS)(text, h1, h2)
    sentinel = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | sentinel | (h3 % 100 >= transformed)
    form = F.when(plain, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    names = ("prefix_chars", "middle_chars")
    c = F.col("infill")
    kept = [F.when(c.form != "plain", c[k]).alias(k) for k in names]
    return (
        docs.withColumn("infill", cut)
        .withColumn("infill", F.struct(c.n, form.alias("form"), *(c[k] for k in names)))
        .withColumn("infill", F.struct(c.n, c.form, *kept, arranged(text, c).alias("output")))
    )


def arranged(text: Column, c: Column) -> Column:
    """The text in its form, by the code points of its prefix and middle."""
    at = c.prefix_chars.cast("int"), c.middle_chars.cast("int")
    prefix, middle = text.substr(F.lit(1), at[0]), text.substr(at[0] + 1, at[1])
    suffix = text.substr(at[0] + at[1] + 1, F.length(text))
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    return F.when(c.form == "plain", text).when(c.form == "psm", psm).otherwise(spm)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from: what stands between the sentinels, in its first order."""

    def pieces(one: str, two: str) -> tuple[Column, Column, Column]:
        rest = F.substring_index(output, two, -1)
        return (
            F.substring_index(F.substring_index(output, two, 1), one, -1),
            F.substring_index(rest, MIDDLE, 1),
            F.substring_index(rest, MIDDLE, -1),
        )

    prefix, suffix, middle = pieces(PREFIX, SUFFIX)
    late_suffix, late_prefix, late_middle = pieces(SUFFIX, PREFIX)
    spm = F.concat(late_prefix, late_middle, late_suffix)
    return F.when(form == "plain", output).when(form == "psm", F.concat(prefix, middle, suffix)).otherwise(spm)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill(documents(spark, sf_dir).select("doc_id", "text"))
    c = F.col("infill")
    return made.select(
        "doc_id", c.n.alias("n"), c.form.alias("form"), c.prefix_chars.alias("prefix_chars"),
        c.middle_chars.alias("middle_chars"), F.sha2(c.output, 256).alias("output_sha256"),
        F.sha2(restored(c.output, c.form), 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
hashed AS (SELECT doc_id, text, units, len(units) AS n,
    CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
        THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
pieces AS (SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS p,
    array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:n], '') AS s FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM pieces
"""
