"""The pipeline stage by stage against plain Python."""

from collections import Counter, defaultdict

import corpus_pipeline
from cohortkit.llm import common, mixing, packing, toxicity
from tests.conftest import SF_SMALL
from tests.llm import helpers as H


def test_stages_on_the_small_tables(spark):
    docs, kept = common.table(spark, SF_SMALL, "documents"), {}
    columns = docs.schema
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, SF_SMALL), "test")
        kept[name] = (docs.collect(), out.collect())
        if name != "best_fit_packing":
            assert out.schema == columns
        docs = out

    before, after = kept["toxicity"]
    machine = toxicity.train(common.table(spark, SF_SMALL, "documents"), common.table(spark, SF_SMALL, "labels"))
    scores = [machine.scorer()((r["text"] or "").encode()) for r in before]
    assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r, s in zip(before, scores) if s < 0.5)

    before, after = kept["exact_dedup"]
    groups = defaultdict(list)
    for r in before:
        groups[H.lower(r["text"])].append(r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(max(g) for g in groups.values())

    before, after = kept["simhash_near_dedup"]
    least = {}
    for r, root in zip(before, H.classes([H.fingerprint(r["text"]) for r in before])):
        least[root] = min(r["doc_id"], least.get(root, r["doc_id"]))
    assert sorted(r["doc_id"] for r in after) == sorted(least.values())

    before, after = kept["source_mixing"]
    text, words, taken = {r["doc_id"]: r["text"] for r in before}, Counter(), Counter()
    for r in before:
        words[r["source"]] += len(H.WORD.findall(r["text"]))
    for r in after:
        assert r["text"] in text[r["doc_id"]]
        taken[r["source"]] += len(H.WORD.findall(r["text"]))
    names = sorted(words)
    for s, t in zip(names, mixing.targets([words[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(words.values()))):
        assert abs(taken[s] - t) <= 2 * mixing.BLOCK_WORDS

    before, after = kept["best_fit_packing"]
    assert sum(r["n_words"] for r in after) == sum(len(H.WORD.findall(r["text"])) for r in before)
    used, caps = Counter(), {}
    for r in after:
        used[r["bin_id"]] += r["n_words"]
        caps[r["bin_id"]] = r["capacity"]
    assert all(caps[b] == min(c for c in packing.LENGTHS if c >= n) for b, n in used.items() if b is not None)


def test_stages_on_awkward_rows(spark):
    docs = H.docs(spark, extra=True)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF_SMALL), "test")
    assert docs.count() > 0
    docs = H.docs(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF_SMALL), "test")
    assert docs.count() == 0
