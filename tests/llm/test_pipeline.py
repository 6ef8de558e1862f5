import corpus_pipeline as pipeline

from .common import frame, prose
from .test_neardup import brute as near
from .test_quality import labels
from .test_substring import brute as cut


def tables(spark, scratch, rows, items):
    frame(spark, rows).drop("kept", "component", "slot", "a b", "length").write.parquet(f"{scratch}/documents.parquet")
    labels(spark, []).write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    return scratch


def test_stages_take_effect_one_after_the_other(spark, scratch):
    base, passage, item = prose(1, 60), prose(2, 30), prose(3, 30)
    rows = [(0, base), (1, base), (2, passage + " " + prose(4, 40)), (3, prose(5, 60) + " " + passage), (4, "too short"), (5, None),
            (6, prose(6, 20) + " " + item), (7, "again " * 50), (8, prose(7, 9000))]
    sf = tables(spark, scratch, rows, [(0, item)])
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.schema == docs.schema, name
        out.write.parquet(f"{sf}/{name}")
        docs = spark.read.parquet(f"{sf}/{name}")
        seen.append({r.doc_id: r.text for r in docs.collect()})
    kept = [(i, t) for i, t in rows if i not in (4, 5, 7)]
    assert set(seen[0]) == {i for i, _ in kept}
    kept = [(i, t) for i, t in kept if near(kept)[i][2]]
    assert set(seen[1]) == {i for i, _ in kept} == {0, 2, 3, 6, 8}
    for (i, t), r in zip(kept, cut(kept)):
        assert seen[2][i].split() == [w for w, g in zip(t.split(), r[4]) if not g]
    assert set(seen[3]) == {0, 2, 3, 8}
    by_run = pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in by_run} == {0, 2, 3, 8} and sum(r.piece for r in by_run if r.doc_id == 8) > 0


def test_empty_documents(spark, scratch):
    assert pipeline.run(spark, tables(spark, scratch, [], [])).count() == 0
