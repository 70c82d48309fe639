from collections import Counter

import numpy as np

import corpus_pipeline
from callweave.llm import quality_crf
from callweave.llm.bytewords import WordHasher, space_words
from callweave.llm.common import documents, table
from tests.llm.test_circulant import brute as near
from tests.llm.test_decontam import brute as tainted
from tests.llm.test_mixing import shared_by_weight
from tests.llm.test_sharding import jump

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_a_brute_force_version(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    docs = {r.doc_id: r for r in documents(spark, SF).collect()}
    model = quality_crf.train(documents(spark, SF), table(spark, SF, "labels"))
    hasher, kept = WordHasher(space_words()), {}
    for i, r in docs.items():
        data = np.frombuffer((r.text or "").encode(), dtype=np.uint8)
        if model.document_scores(*quality_crf.line_features(hasher, data, np.array([0, len(data)])))[0] >= 0.3:
            kept[i] = r
    classes = near([(i, r.text) for i, r in kept.items()], 5, 80)
    kept = {i: r for i, r in kept.items() if classes[i][1] == i}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    bad = {row[0] for row in tainted([(i, r.text) for i, r in kept.items()], items) if row[4]}
    kept = {i: r for i, r in kept.items() if i not in bad}
    assert 0 < len(kept) < len(docs) and bad
    got = corpus_pipeline.run(spark, SF).collect()
    times = Counter(r.doc_id for r in got)
    assert set(times) <= set(kept) and max(times.values()) <= 3
    size = {i: len((r.text or "").split()) for i, r in kept.items()}
    total, taken = Counter(), Counter()
    for i, r in kept.items():
        total[r.source] += size[i]
        taken[r.source] += size[i] * times[i]
    order = sorted(n for n in total if n is not None) + [None] * (None in total)
    target = shared_by_weight({s: total[s] for s in order}, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, sum(total.values()))
    for s in order:
        assert abs(taken[s] - target[s]) <= max(size[i] for i, r in kept.items() if r.source == s)
    assert all(r.shard == jump(r.doc_id, 8) for r in got)
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_stages_carry_columns_of_any_name(spark, make_docs):
    docs = make_docs([(i, f"word{i} and some other words of document {i} " * 6, "ab"[i % 2]) for i in range(40)],
                     _row=1, _times=2, row=3, _quality=4, _cw_row=5, _dedupe_k1=6, k1=7, text_key="t", sources="s")
    before = sorted(map(tuple, docs.collect()))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "nothing that occurs in any of these documents at all so that nothing goes away here")], "item_id long, text string")
    for stage in (lambda d: quality_crf.keep_good(d, labels), corpus_pipeline.circulant.deduplicate,
                  lambda d: corpus_pipeline.decontam.decontaminate(d, items), corpus_pipeline.mixing.apply_mix):
        after = stage(docs)
        assert after.columns == docs.columns
        assert set(map(tuple, after.collect())) <= set(before)
