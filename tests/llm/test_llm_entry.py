"""Registered training-data queries and the pipeline."""

import array
import collections
import os
import sys
import zlib

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from oracle_check import rows_of  # noqa: E402
from scorewright.llm import catalog, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in catalog.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(catalog.QUERIES) <= set(names) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "mixing", "pieces"]


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = catalog.QUERIES[name](spark, SF)
    rel = con.sql(catalog.SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_stages_on_the_given_documents(spark):
    docs = catalog.table(spark, SF, "documents")
    truth = {r.doc_id: r.quality for r in catalog.table(spark, SF, "labels").collect()}
    kept = corpus_pipeline.quality(spark, docs, SF).cache()
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in kept.collect()}
    clean = [d for d, q in truth.items() if q == 1]
    assert sum(d in ids for d in clean) / len(clean) > 0.97
    one = corpus_pipeline.near_duplicates(spark, kept, SF).cache()
    classes = {r.doc_id: r.component_id for r in simhash.near_duplicates(kept).collect()}
    assert one.schema == docs.schema and sorted(r.doc_id for r in one.collect()) == sorted(set(classes.values()))
    mixed = corpus_pipeline.mix_sources(spark, one, SF).cache()
    times = collections.Counter(r.doc_id for r in mixed.collect())
    assert mixed.schema == docs.schema and set(times) == set(classes.values()) and max(times.values()) <= 2
    last = corpus_pipeline.piece_ids(spark, mixed, SF).collect()
    assert collections.Counter(r.doc_id for r in last) == times and all(r.round_trip for r in last)


def hostile_folder(hostile, empty, scratch, docs):
    docs.write.parquet(f"{scratch}/documents.parquet")
    hostile.sparkSession.createDataFrame([(1, 1, 0), (4, 0, 0), (5, 0, 1), (9, 1, 0), (None, 1, 1)],
                                         "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    return scratch


def test_pipeline_on_hostile_documents(hostile, empty, scratch, spark):
    sf = hostile_folder(hostile, empty, scratch, hostile)
    out = corpus_pipeline.run(spark, sf).collect()
    # labels of both classes are there, so the classifier decides; of what it
    # keeps one row of each component goes on, at least once, at most twice
    check_ids(out, corpus_pipeline.quality(spark, hostile, sf))


def components_of(rows):
    """Rows by SimHash component, by comparing all pairs."""
    from test_llm_simhash import fingerprint

    prints = [fingerprint(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r)
    return list(groups.values())


def check_ids(out, kept):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=catalog.tokenizer_path("piece_bpe_32k.model"))
    rows = kept.collect()
    times = collections.Counter((r.doc_id, r.source, tuple(r.ids)) for r in out)
    assert max(times.values()) <= 2 and rows
    found = 0
    for members in components_of(rows):
        least = min((r.doc_id is None, r.doc_id or 0) for r in members)
        # the space mark itself is told from a space by neither
        may = {(r.doc_id, r.source, tuple(model.encode((r.text or "")))) for r in members if (r.doc_id is None, r.doc_id or 0) == least}
        here = [key for key in times if key in may]
        assert len(here) == 1
        found += 1
    assert found == len(times)


def test_pipeline_against_brute_force(spark):
    """All stages on the small tables: the classifier's own decisions, then
    components by all pairs, at most twofold repetition, the library's ids."""
    kept = corpus_pipeline.quality(spark, catalog.table(spark, SF, "documents"), SF)
    check_ids(corpus_pipeline.run(spark, SF).collect(), kept)


def test_kept_row_of_equal_texts_is_defined(spark):
    rows = [(1, "same words here again", s, n) for s, n in (("b", 2), ("a", 1), ("c", 3))] * 2
    kept = [simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string, n int").repartition(n)).collect()
            for n in (1, 5)]
    assert len(kept[0]) == 1 and kept[0] == kept[1]


def test_pipeline_on_no_documents(hostile, empty, scratch, spark):
    sf = hostile_folder(hostile, empty, scratch, empty)
    assert corpus_pipeline.run(spark, sf).collect() == []


def test_op5_returns_the_ids(spark):
    rows = catalog.QUERIES["op5_sentencepiece"](spark, SF).collect()
    assert len(rows) == catalog.table(spark, SF, "documents").count()
    assert all(len(r.ids) == r.n_pieces and zlib.crc32(array.array("i", r.ids).tobytes()) == r.ids_crc32 for r in rows)


@pytest.mark.parametrize("labels", [[], [(1, None), (None, 1)], [(1, 1), (1, 0)], [(1, 0), (4, 0), (5, 0), (9, 0)],
                                    [(1, 1), (4, 1), (5, 1), (9, 1)], [(-7, 0), (-8, 1)]])
def test_quality_stage_keeps_all_where_nothing_is_learnt(hostile, scratch, spark, labels):
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{scratch}/labels.parquet")
    kept = corpus_pipeline.quality(spark, hostile, scratch)
    assert kept.schema == hostile.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, hostile.collect()))
