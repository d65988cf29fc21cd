"""Stages of the pipeline on repeated rows, rows without ids, clashing names and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martloom.llm import decontaminate, exact_dedup, simhash, substring_dedup

NAMES = "doc_id long, text string, _digest string, digest string, _row int, row string, number int, _mark int, fp string, scan int, id int, _scan0 int"


def table(spark, rows):
    return spark.createDataFrame([(*r, f"d{i}", "x", i, "y", i, i, "z", i, i, i) for i, r in enumerate(rows)], NAMES)


def some(i):
    return " ".join(f"w{i}x{j}" for j in range(40))


ROWS = [
    (1, some(1)), (1, some(1)), (2, some(1).upper()), (None, some(2)), (None, some(2)), (3, some(3)), (3, some(3) + " end"), (4, None), (5, ""), (None, None),
    (6, "same id, other text"), (6, "and another one"), (7, some(7)), (7, some(7)), (7, some(7)),
]


def test_of_equal_texts_one_row_stays(spark):
    docs = table(spark, ROWS)
    left = exact_dedup.exact_dedup(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    assert sorted((r.doc_id or 0, (r.text or "").lower()) for r in rows) == sorted(
        [(2, some(1)), (0, some(2)), (3, some(3)), (3, some(3) + " end"), (5, ""), (6, "same id, other text"), (6, "and another one"), (7, some(7))]
    )
    whole = {tuple(r) for r in docs.collect()}
    assert all(tuple(r) in whole for r in rows)
    assert sorted(map(str, exact_dedup.exact_dedup(docs).collect())) == sorted(map(str, rows))


def test_of_near_texts_one_row_stays(spark):
    docs = table(spark, ROWS)
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    whole = {tuple(r) for r in docs.collect()}
    assert all(tuple(r) in whole for r in rows)
    # as many rows as there are groups; of a group, the smallest id
    found = simhash.near_duplicates(docs.select("doc_id", "text")).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.fp, set()).add(r.component_id)
    assert all(len(v) == 1 for v in groups.values())
    kept = [r.doc_id for r in rows]
    assert kept.count(1) == 1 and kept.count(2) == 0 and kept.count(7) == 1
    assert {r.component_id for r in found} == set(kept)
    assert len([r for r in rows if r.doc_id is None]) == 1  # the two rows of text 2; the null text is with ids 4 and 5


def test_names_that_operators_use_inside(spark):
    docs = table(spark, ROWS)
    bench = spark.createDataFrame([(1, some(3)), (2, some(9)), (3, "same id")], "item_id long, text string")
    for limit in (1, 200_000):
        told = decontaminate.contamination(docs, bench, set_windows=limit)
        assert told.columns == [*docs.columns, "contamination"] and told.count() == len(ROWS)
        assert sorted({r.doc_id for r in told.filter("contamination.contaminated").collect()}) == [3, 6]
        assert {tuple(r)[:-1] for r in told.collect()} == {tuple(r) for r in docs.collect()}
    cut = substring_dedup.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    assert sorted(r._row for r in cut.collect()) == list(range(len(ROWS)))


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    """Odd documents beside the given labels and benchmark."""
    out = tmp_path_factory.mktemp("odd")
    given = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{given}/documents.parquet")
    more = spark.createDataFrame([(i, t) for i, t in ROWS], "doc_id long, text string")
    more = more.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("int").alias("n_chars"))
    shape = {f.name: f.dataType for f in docs.schema.fields}
    odd = more.select(*[F.col(c).cast(t) for c, t in shape.items()])
    odd.unionByName(docs.limit(0)).write.parquet(f"{out}/odd/documents.parquet")
    docs.limit(0).write.parquet(f"{out}/none/documents.parquet")
    for name in ("labels", "benchmark"):
        table_ = spark.read.parquet(f"{given}/{name}.parquet")
        table_.write.parquet(f"{out}/odd/{name}.parquet")
        table_.limit(0).write.parquet(f"{out}/none/{name}.parquet")
    return out


def test_pipeline_of_odd_rows(spark, folder):
    got = corpus_pipeline.run(spark, f"{folder}/odd").collect()
    ids = [r.doc_id for r in got]
    assert ids.count(1) == 0 and ids.count(2) == 1 and ids.count(7) == 1 and ids.count(None) == 1
    assert all(r.taken <= 3 * r["size"] for r in got)


def test_pipeline_of_empty_tables(spark, folder):
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0
