import corpus_pipeline
from compare import duckdb_over, spark_rows, sql_rows

from shelfline.llm.oracles import ORACLES
from shelfline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_sql_twins(spark):
    con = duckdb_over(FOLDER)
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, FOLDER)
        columns, expected = sql_rows(con, sql)
        assert sorted(df.columns) == columns
        assert spark_rows(df) == expected


def test_stages(spark, tmp_path):
    """Every stage against a plain rule over what its predecessor kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [{r.doc_id: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == docs.columns
            docs = out
        kept.append({r.doc_id: r for r in out.collect()})
    start, good, unique, apart, cut, packed = kept
    assert set(unique) == {min(d for d in good if good[d].text.split() == good[k].text.split()) for k in good}
    sets = {}
    for d, r in unique.items():
        words = r.text.lower().split()
        sets[d] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}
    for d in apart:
        assert all(len(sets[d] & sets[o]) < 0.8 * len(sets[d] | sets[o]) for o in apart if o != d)
    for d in set(unique) - set(apart):
        assert any(len(sets[d] & sets[o]) >= 0.8 * len(sets[d] | sets[o]) for o in unique if o != d)
    assert set(cut) <= set(apart) and set(packed) == set(cut)
    assert all(r.n_chars == len(r.text) for r in cut.values())
    windows = set()
    for d in sorted(cut):
        words = cut[d].text.split()
        own = {tuple(words[i : i + 50]) for i in range(len(words) - 49)}
        assert not own & windows
        windows |= own
    assert len(good) < len(start)
