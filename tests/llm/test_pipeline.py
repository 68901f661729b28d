"""Each stage against a brute-force version of its decision."""

import corpus_pipeline
from gridstone.llm.decontaminate import find_contamination
from gridstone.llm.near_join import near_classes
from gridstone.llm.pii import base_spans
from gridstone.llm.quality import score_quality, train
from gridstone.llm.state import written

from .test_operators import brute_classes, check_packing, library  # noqa: F401

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, seen[-1], SF), f"test-{name}")
        if name != "packing":
            assert out.columns == docs.columns
            assert out.where("n_chars <> length(text)").count() == 0
        seen.append(out)
    raw, good, single, clean, safe, packed = seen
    ids = lambda d: {r["doc_id"] for r in d.select("doc_id").collect()}

    model = train(raw, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(good) == {r["doc_id"] for r in score_quality(raw, model).collect() if r["score"] >= corpus_pipeline.LEAST_SCORE}

    pairs = sorted((r["doc_id"], r["text"]) for r in good.collect())
    want = brute_classes(pairs)
    assert sorted(tuple(r) for r in near_classes(good).collect()) == want
    assert ids(single) == {c for _, c, _ in want}

    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    hits = {r["doc_id"]: (sum(s["end"] - s["start"] for s in r["hit_spans"]), r["n_words"]) for r in find_contamination(single, bench).collect()}
    assert ids(clean) == {i for i, (hit, n) in hits.items() if hit <= n * corpus_pipeline.MOST_HIT}
    assert find_contamination(clean, bench).where("size(hit_spans) > 0").count() == 0
    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (single, clean))
    assert all(after[i] == before[i] for i in after if not hits[i][0])

    assert ids(safe) == ids(clean)
    assert all(not base_spans(r["text"]) for r in safe.collect())

    tokens = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids + [2] for r in safe.collect()}
    check_packing(packed.collect(), tokens, 1024)


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, None), (2, "", "", "", 0), (3, "a b c", "en", "x", 5), (3, "a b c", "en", "x", 5)], schema)
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            docs.collect()
