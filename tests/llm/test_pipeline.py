from __future__ import annotations

import corpus_pipeline
from pricetrail.llm import decontaminate, simhash, toxicity
from pricetrail.llm.common import table


def test_stages(spark, sf):
    """Every stage keeps the columns, and takes out what its operator finds in what it was given."""
    docs = table(spark, sf, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, docs, sf), name)
        assert after.schema == docs.schema
        before, left = ({r.doc_id for r in x.collect()} for x in (docs, after))
        assert left <= before
        if name == "toxicity":
            rows = toxicity.classify_toxicity(docs, table(spark, sf, "labels")).collect()
            assert before - left == {r.doc_id for r in rows if r.predicted}
        elif name == "near_duplicates":
            rows = simhash.simhash_groups(docs).collect()
            assert left == {r.component_id for r in rows}
        elif name == "decontamination":
            found = decontaminate.contaminated(docs, table(spark, sf, "benchmark")).collect()
            assert before - left == {r.doc_id for r in found}
        else:
            assert left == before
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    whole = sorted(map(tuple, ((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, sf).collect())))
    assert whole == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_stages_on_odd_rows(spark, sf, docs, prose):
    frame = docs((1, None), (2, ""), (None, prose(1)), (4, prose(2, 20_000)), (4, prose(2, 20_000)), (5, prose(3)))
    for source in (frame, frame.limit(0)):
        rows = source
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = corpus_pipeline.stored(stage(spark, rows, sf), name)
            assert rows.schema == frame.schema
        assert corpus_pipeline.STAGES[-1][1](spark, rows, sf).count() >= rows.count()
