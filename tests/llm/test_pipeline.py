"""The pipeline against brute force, stage by stage on what the stage before kept."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tallystick.llm import decontaminate, pii
from tallystick.llm.oracles import statements
from tests.comparing import duck, rows_of
from tests.llm.frames import EDGES, PROSE, documents
from tests.llm.test_simhash import classes, slow_fingerprint


def run_stages(spark, docs, folder):
    outputs = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage{number}/documents.parquet"
        stage(spark, docs, str(folder)).write.parquet(path)
        docs = spark.read.parquet(path)
        outputs.append(docs)
    return outputs


@pytest.fixture(scope="module")
def given(spark, star_folder, tmp_path_factory):
    """The smallest data set and the awkward rows."""
    folder = tmp_path_factory.mktemp("corpus")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    odd = documents(spark, [(None if i is None else i + 5000, t, lang, s) for i, t, lang, s in EDGES])
    given = spark.read.parquet(f"{star_folder}/documents.parquet").select(*columns)
    given.unionByName(odd.select(*columns)).write.parquet(f"{folder}/documents.parquet")
    items = [(1000, PROSE[20:120])]
    bench = spark.read.parquet(f"{star_folder}/benchmark.parquet").select("item_id", "text")
    bench.unionByName(spark.createDataFrame(items, bench.schema)).write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, given):
    docs = spark.read.parquet(f"{given}/documents.parquet")
    spoken, single, clean, private, mixed = run_stages(spark, docs, given)
    assert spoken.columns == single.columns == clean.columns == private.columns == docs.columns

    def texts(frame):
        return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)

    assert texts(spoken) == [x for x in texts(docs) if x[1] is not None and any(map(str.isalpha, x[1]))]

    before = texts(spoken)
    roots = classes([slow_fingerprint(t) for _, t in before])
    smallest = {}
    for (i, _), root in zip(before, roots, strict=True):
        smallest[root] = min((x for x in (i, smallest.get(root)) if x is not None), default=None)
    assert sorted(map(str, smallest.values())) == sorted(str(i) for i, _ in texts(single))
    assert all(row in before for row in texts(single))

    items = [decontaminate.normalise(r["text"]) for r in spark.read.parquet(f"{given}/benchmark.parquet").collect()]
    items = [t for t in items if len(t) >= decontaminate.MIN_CHARS]

    def leaks(text):
        held = decontaminate.normalise(text)
        return any(decontaminate.best_end(t, held)[0] <= decontaminate.budget(len(t)) for t in items)

    some = [x for x in texts(single) if len(x[1]) < 1500]
    assert [x for x in some if not leaks(x[1])] == [x for x in texts(clean) if len(x[1]) < 1500]
    assert {i for i, _ in texts(clean)} <= {i for i, _ in texts(single)}

    shown = {r["doc_id"]: r for r in private.collect()}
    for doc_id, text in texts(clean):
        row = shown[doc_id]
        assert row["n_chars"] == len(row["text"])
        assert not pii.base_spans(row["text"]) or "<" in row["text"]
        if not list(pii.zones(text)) and not pii.base_spans(text):
            assert row["text"] == text
        for start, stop, _ in pii.base_spans(text):
            assert text[start:stop] not in row["text"]

    connection = duck(str(given))
    connection.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{given}/stage3/documents.parquet/*.parquet'")
    relation = connection.sql(statements()["op6_mix_sources"])
    assert rows_of(mixed.columns, mixed.collect()) == rows_of(relation.columns, relation.fetchall())


def test_run_gives_the_last_stage(spark, star_folder):
    rows = corpus_pipeline.run(spark, star_folder)
    assert rows.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert 0 < rows.count() <= spark.read.parquet(f"{star_folder}/documents.parquet").count()


@pytest.mark.parametrize("text", [None, "x" * 50_001])
def test_language_stage_keeps_letters_without_a_model(spark, star_folder, text):
    rows = [(1, PROSE, None, "a"), (2, "12 ...", None, "a"), (3, None, "en", "a"), (4, text, "en" if text else None, "a")]
    kept = corpus_pipeline.language_id(spark, documents(spark, rows), star_folder)
    assert sorted(r["doc_id"] for r in kept.collect()) == ([1, 4] if text else [1])


def test_stages_on_no_documents(spark, given, tmp_path):
    empty = spark.read.parquet(f"{given}/documents.parquet").where("false")
    spark.read.parquet(f"{given}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [frame.count() for frame in run_stages(spark, empty, tmp_path)] == [0] * 5
