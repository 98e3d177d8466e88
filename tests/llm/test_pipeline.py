"""The pipeline's stages, each against its own input, and the registered queries."""

from __future__ import annotations

import inspect
import random

import duckdb
import public_tokenizers as public
import pytest
import tiktoken

import __spark_entry__ as driver
import corpus_pipeline
from ratewatch.llm import bpe, mixing, pii, quality, queries, simhash

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    frames = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], DATA).write.parquet(f"{folder}/{name}")
        frames.append(spark.read.parquet(f"{folder}/{name}"))
    return frames


def test_stages_keep_the_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "encoding"]
    assert all(f.columns == steps[0].columns for f in steps[:-1])


def test_quality_rejects_by_score(spark, steps):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    scores = {r["doc_id"]: r["predicted"] for r in quality.qualities(steps[0], labels).collect()}
    assert {r["doc_id"] for r in steps[1].collect()} == {i for i, keep in scores.items() if keep}


def test_one_of_each_group_stays(steps):
    before, after = steps[1].collect(), {r["doc_id"] for r in steps[2].collect()}
    components = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(steps[1]).collect()}
    assert after == set(components.values()) and len(after) < len(before)


def test_personal_data_is_gone(steps):
    texts = {r["doc_id"]: r["text"] for r in steps[2].collect()}
    for r in steps[3].collect():
        assert not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not pii.base_spans(texts[r["doc_id"]]):
            assert r["text"] == texts[r["doc_id"]]


def test_the_mix_follows_its_plan(steps):
    plan = {r["doc_id"]: r for r in mixing.mix(steps[3]).collect()}
    copies = [r["doc_id"] for r in steps[4].collect()]
    assert all(copies.count(i) == len(r["units"]) for i, r in plan.items()) and set(copies) <= set(plan)


def test_ids_are_the_library_s(steps):
    ranks = bpe.read_ranks(public.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r["doc_id"], library.encode_ordinary(r["text"])) for r in steps[4].collect())
    assert sorted((r["doc_id"], list(r["ids"])) for r in steps[5].collect()) == want


def test_run_applies_all_stages(spark, steps):
    got = corpus_pipeline.run(spark, DATA)
    key = lambda f: sorted((r["doc_id"], r["ids_sha256"]) for r in f.collect())
    assert key(got) == key(steps[-1])


@pytest.mark.parametrize(
    "rows", [[], [(None, None, None, None, None)], [(1, None, None, "s", 3), (1, "a b", "en", None, 3), (1, "a b", "en", None, 3)]]
)
def test_stages_stand_nulls_repeats_and_no_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        assert out.count() <= 3 * len(rows)


def test_stages_stand_clashing_columns(spark):
    more = ["score", "size", "ids", "fp", "target", "units", "root", "block"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in more)
    docs = spark.createDataFrame([(i, f"some words {i} a b c", "en", "s", 1, *more) for i in range(5)], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns
        assert all(r["units"] == "units" and r["size"] == "size" for r in out.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == 5


def test_queries_are_registered():
    names = driver.queries()
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.queries()) <= set(names) and "pipeline" in names
    assert all(len(inspect.signature(names[n]).parameters) == 2 for n in queries.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.execute(queries.oracle_sql()[name]).fetchall()
    columns = [d[0] for d in con.description]
    got = driver.queries()[name](spark, DATA)
    assert set(got.columns) == set(columns)
    key = lambda rows: sorted(map(repr, rows))
    assert key(tuple(r[c] for c in columns) for r in got.collect()) == key(map(tuple, want))


def test_results_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    order = random.Random(1).randint(5, 9)
    for make in (simhash.near_duplicates, pii.personal_data, mixing.mix):
        key = lambda f: sorted(map(repr, f.collect()))
        assert key(make(docs)) == key(make(docs.repartition(order)))
