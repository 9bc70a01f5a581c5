"""The corpus pipeline: its stages by brute force on the smallest documents, and odd rows."""

import collections

import corpus_pipeline
from marketlake.llm import decontaminate, line_dedup, simhash, toxicity
from marketlake.llm.common import table
from tests.conftest import SF_DIR
from tests.llm.test_operators import DOCS, ROWS, check_packing


def test_stages_one_by_one(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, names = docs.columns, [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stages = dict(corpus_pipeline.STAGES)

    def rows(df):
        return {r["doc_id"]: r["text"] for r in df.collect()}

    labels = table(spark, SF_DIR, "labels")
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(docs, labels).collect()}
    civil = stages["toxicity"](spark, docs, SF_DIR)
    assert civil.columns == columns
    assert set(rows(civil)) == {i for i, toxic in scores.items() if not toxic}

    cut = stages["line dedup"](spark, civil, SF_DIR)
    assert cut.columns == columns
    lost = line_dedup.removed_lines(civil).count()
    before, after = rows(civil), rows(cut)
    assert sum(before[i] != after[i] for i in before) == lost and before.keys() == after.keys()
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect() if r["text"] != before[r["doc_id"]])

    single = stages["SimHash near-dedup"](spark, cut, SF_DIR)
    assert single.columns == columns
    prints = {i: simhash.fingerprint(t) for i, t in after.items()}
    classes = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(cut).collect()}
    assert set(rows(single)) == set(classes.values()) and len(prints) == len(classes)

    clean = stages["benchmark decontamination"](spark, single, SF_DIR)
    assert clean.columns == columns
    matcher = decontaminate.Matcher(
        [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()], 0.2
    )
    kept = rows(clean)
    assert set(kept) == {i for i, t in rows(single).items() if not matcher.contains(t)}

    packed = stages["best-fit packing"](spark, clean, SF_DIR).collect()
    check_packing(packed, list(kept.items()), 4096)

    whole = collections.Counter(
        (r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, SF_DIR).collect()
    )
    assert whole == collections.Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed)


def test_stages_of_odd_and_no_rows(spark):
    docs = spark.createDataFrame([(i, t, None, None, None, 1, 2, 3, 4, 5, 6) for i, t in ROWS], DOCS)
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, SF_DIR)
            assert out.columns == rows.columns
            rows = out
        _, last = corpus_pipeline.STAGES[-1]
        ids = {r["doc_id"] for r in last(spark, rows, SF_DIR).collect()}
        assert ids <= {i for i, _ in ROWS}
