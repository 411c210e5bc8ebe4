from __future__ import annotations

import corpus_pipeline
from tests.llm.fixtures import docs, prose
from tests.llm.test_pair_operators import repeated_id_rows, same_rows
from tests.llm.test_text_operators import WORD


def test_stages_on_edge_rows(spark, tmp_path, monkeypatch):
    rows = [*repeated_id_rows(), (20, prose(60, 30) + " " + prose(61, 40), "en", "a"),
            (21, prose(62, 30) + " password: correcthorse", "en", "b")]
    docs(spark, rows, extra=False).coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    # one class only: every text scores 1
    spark.createDataFrame([(k, 1) for k in range(1, 30)], "doc_id bigint, quality int").write.parquet(
        str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, prose(61, 40))], "item_id bigint, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    seen = {}

    def watched(name, stage):
        def run(session, df, sf_dir):
            seen[name, "in"] = [tuple(r)[:4] for r in df.collect()]
            out = corpus_pipeline.staged(stage(session, df, sf_dir))
            seen[name, "out"] = [tuple(r)[:5] for r in out.collect()]
            return out
        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, watched(n, s)) for n, s in corpus_pipeline.STAGES])
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    out = {n: [r[:4] for r in seen[n, "out"]] for n, _ in corpus_pipeline.STAGES}
    assert sorted(map(str, out["quality"])) == sorted(map(str, rows))
    assert same_rows(out["near_duplicates"], seen["near_duplicates", "in"])
    clean = [r for r in seen["benchmark", "in"] if prose(61, 40) not in (r[1] or "")]
    assert sorted(map(str, out["benchmark"])) == sorted(map(str, clean)) and len(clean) < len(out["near_duplicates"])
    masked = [(i, t and t.replace("password: correcthorse", "[assign]"), *x) for i, t, *x in clean]
    assert sorted(map(str, out["secrets"])) == sorted(map(str, masked))
    assert all(r[4] == (None if r[1] is None else len(r[1])) for r in seen["secrets", "out"])
    words = [(i, s, len(WORD.findall(t or ""))) for i, t, _, s in masked]
    assert sorted(map(str, words)) == sorted(str((r.doc_id, r.source, r["size"])) for r in mixed)
