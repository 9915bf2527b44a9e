"""The pipeline's stages on a small corpus with planted cases, and the
registered queries against their SQL."""

import os
import random

import pytest

from tests.llm.test_operators import AWKWARD, SCHEMA, prose

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rng, rows, labels = random.Random(1), [], []
    bench = [(i, prose(7000 + i, 30)) for i in range(5)]
    for i in range(300):
        text = prose(i, rng.randint(40, 90))
        kind = i % 10
        if kind == 1:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 2:
            text = "idiot " + text + " worthless scum"
        elif kind == 3:
            text = prose(i - 3, 60) + " tail"
        elif kind == 0:
            text = prose(i, 60)
        elif kind == 4:
            text = text + " " + bench[i % 5][1]
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        labels.append((i, int(kind != 1), int(kind == 2)))
    rows += [(1000 + n, t, None, None, None) for n, (_, t) in enumerate(AWKWARD)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_do_what_they_say(spark, folder):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert len(names) == 5
    stage = dict(P.STAGES)
    out = {}
    for n in names[:-1]:
        df = stage[n](spark, docs, folder)
        assert df.columns == docs.columns
        out[n] = [r["doc_id"] for r in df.collect()]
    ids = set(range(300))
    good = set(out["quality"]) & ids
    assert not good & {i for i in ids if i % 10 in (1, 2)} and len(good & {i for i in ids if i % 10 not in (1, 2)}) >= 235
    near = set(out["near_duplicates"]) & ids
    assert near == {i for i in ids if i % 10 != 3}
    assert set(out["decontamination"]) & ids == {i for i in ids if i % 10 != 4}
    assert set(out["mixing"]) <= {r["doc_id"] for r in docs.collect()} and len(out["mixing"]) > 150


def test_run_packs_what_the_stages_keep(spark, folder):
    import corpus_pipeline as P
    packed = P.run(spark, folder).collect()
    held = {d for r in packed for d in r["doc_ids"]}
    assert held and not held & {i for i in range(300) if i % 10 in (1, 2, 3, 4)}


def test_stages_on_an_empty_table(spark, folder):
    import corpus_pipeline as P
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        assert stage(spark, docs, folder).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF001), reason="test tables absent")
def test_queries_match_their_sql(spark):
    from keelson.llm.queries import QUERIES, SQL
    from keelson.plans.check import duck_connection, value_hash
    con = duck_connection(SF001)
    assert sorted(q.split("_")[0] for q in QUERIES) == sorted(f"op{i}" for i in range(1, 11))
    for name, sql in SQL.items():
        df, rel = QUERIES[name](spark, SF001), con.sql(sql)
        assert value_hash(df.columns, [tuple(r) for r in df.collect()]) == value_hash(rel.columns, rel.fetchall()), name
