import corpus_pipeline
from tessera.llm.common import read

from . import test_decontaminate, test_near_copies, test_quality_rules, test_tokens
from .cases import empty, odd, plain, table


def test_stages_against_brute_force(spark, sf):
    rows = {r[0]: r for r in table(sf, "documents")}
    items = table(sf, "benchmark")
    docs = read(spark, sf, "documents")
    (_, rules), (_, dedup), (_, clean), (_, mix), (_, tokens) = corpus_pipeline.STAGES
    kept = {i for i, r in rows.items() if test_quality_rules.brute(i, r[1])[-1]}
    docs = rules(spark, docs, sf)
    assert sorted(r.doc_id for r in docs.collect()) == sorted(kept) and docs.columns == read(spark, sf, "documents").columns
    kept = {i for i, c in test_near_copies.brute([(i, rows[i][1]) for i in sorted(kept)]) if i == c}
    docs = dedup(spark, docs, sf)
    assert sorted(r.doc_id for r in docs.collect()) == sorted(kept)
    kept = {r[0] for r in test_decontaminate.brute([(i, rows[i][1]) for i in sorted(kept)], items) if not r[2]}
    docs = clean(spark, docs, sf)
    assert sorted(r.doc_id for r in docs.collect()) == sorted(kept)
    docs = mix(spark, docs, sf)
    taken = [r.doc_id for r in docs.collect()]
    assert set(taken) <= kept and all(taken.count(i) <= 3 for i in kept)
    got = plain(tokens(spark, docs, sf))
    assert got == test_tokens.brute([(i, rows[i][1]) for i in taken])
    assert plain(corpus_pipeline.run(spark, sf)) == got


def test_odd_rows_pass_every_stage(spark, sf):
    for df in (odd(spark), empty(spark)):
        columns = df.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, sf)
            assert df.columns == columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, df, sf).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
