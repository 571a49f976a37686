import random

import corpus_pipeline as pipeline
from shelfwise.llm.queries import llm_queries
from shelfwise.llm.sql import llm_sql
from tests.compare import compare, duck
from tests.llm.conftest import sentence
from tests.llm.test_simhash import brute

import numpy as np
import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, s, len(t or "")) for i, t, g, s in rows], COLUMNS)


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(i, "\n".join(sentence(rng, 30) for _ in range(3)), "en", "hot" if i % 3 else f"s{i % 4}") for i in range(60)]
    out += [(100 + i, out[i][1], "en", "s1") for i in range(5)]  # copies
    out += [(200 + i, out[i][1].replace("\n", " ") + " tail", "en", "s1") for i in range(20, 25)]  # near copies on one line
    shared = sentence(rng, 60)
    out += [(300 + i, f"{sentence(rng, 25)}\n{shared}", "en", "s2") for i in range(5)]
    return [*out, (400, "123 456", "en", "s2"), (401, None, None, None), (402, "", "en", "s2")]


def test_each_stage_decides_and_keeps_the_columns(spark, sf_dir, rows):
    docs = frame(spark, rows)
    named = pipeline.identify_language(spark, docs, sf_dir)
    assert named.columns == list(pipeline.COLUMNS)
    assert texts(named).keys() == {r[0] for r in rows} - {400, 401, 402}
    lines = pipeline.drop_repeated_lines(spark, named, sf_dir)
    left = texts(lines)
    assert not left.keys() & set(range(100, 105)) and lines.columns == list(pipeline.COLUMNS)
    assert [len(left[300 + i].split("\n")) for i in range(5)] == [2, 1, 1, 1, 1]
    once = pipeline.drop_near_duplicates(spark, lines, sf_dir)
    kept = texts(once)
    assert set(range(60)) <= kept.keys() and once.columns == list(pipeline.COLUMNS)
    mixed = pipeline.mix_sources(spark, once, sf_dir)
    drawn = [r.doc_id for r in mixed.collect()]
    assert set(drawn) == kept.keys() and max(map(drawn.count, drawn)) <= 2 and mixed.columns == list(pipeline.COLUMNS)


def test_near_duplicates_keep_one_of_each_group(spark, sf_dir):
    rng = random.Random(2)
    base = [sentence(rng, 400) for _ in range(6)]
    rows = [(10 * i + k, t + (" end" if k else ""), "en", "s") for i, t in enumerate(base) for k in range(3)]
    rows += [(0, rows[0][1], "en", "s"), (None, base[0], "en", "s")]
    found = pipeline.drop_near_duplicates(spark, frame(spark, rows), sf_dir).collect()
    first = {key for key, _, low in brute([r[:2] for r in rows if r[0] is not None]) if key == low}
    assert sorted(str(r.doc_id) for r in found) == sorted(["None", *map(str, first)])
    assert first >= {10 * i for i in range(6)} and len(first) < 12


def test_run_and_empty_table(spark, sf_dir, tmp_path):
    found = pipeline.run(spark, sf_dir).collect()
    assert found and len({(r.sequence_id, r.offset) for r in found}) == len(found)
    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", list(llm_sql()))
def test_sql(spark, sf_dir, name):
    outcome = compare(spark, duck(sf_dir), sf_dir, name, llm_queries()[name], llm_sql()[name])
    assert outcome["problem"] == ""


def test_registered_names(spark):
    from __spark_entry__ import oracle_sql, queries

    assert {int(n[2:].split("_")[0]) for n in queries() if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in queries() and set(oracle_sql()) <= set(queries())
    assert np.all([callable(q) for q in queries().values()])
