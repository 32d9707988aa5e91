"""Pipeline stages on odd tables: null and repeated ids, clashing names, no rows."""

import corpus_pipeline

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars int, quality_score double, n_lines string, n_dropped string, "
    "toxicity string, id string, text_mark string, rest string, term string, component_id string, stays string"
)
PROSE = "a quiet river ran under the old stone bridge near town"
ROWS = [
    (1, PROSE), (1, "another text with the same id but words of its own"), (2, PROSE), (2, PROSE), (None, PROSE),
    (3, "some words and then one two three four five six seven eight nine ten"), (3, "only clean words under this id"),
    (None, "one two three four five six seven eight nine ten"), (4, None), (5, ""), (6, "menu\nsix"),
    *[(n, f"menu\npage {n} alone") for n in range(10, 16)],
]


def tables(spark, folder):
    rows = [(i, t, "en", None if i == 4 else "s", 7, 0.5, "kept", None, "x", "x", "x", "x", "x", "x", "x") for i, t in ROWS]
    docs = spark.createDataFrame(rows, SCHEMA)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_stages_keep_the_right_rows_and_all_columns(spark, tmp_path):
    docs = tables(spark, tmp_path)
    stages = dict(corpus_pipeline.STAGES)
    found = {name: stages[name](spark, docs, str(tmp_path)) for name in list(stages)[:-1]}
    for name, made in found.items():
        assert made.columns == docs.columns, name
        assert all(r.n_lines == "kept" and r.quality_score == 0.5 and r.term == "x" for r in made.collect()), name
    key = lambda df: sorted(((r.doc_id or 0, r.text or "") for r in df.collect()))
    all_rows = sorted((i or 0, t or "") for i, t in ROWS)
    assert key(found["quality"]) == all_rows
    lines = {r.doc_id: (r.text, r.n_chars) for r in found["line_dedup"].collect() if (r.doc_id or 0) >= 6}
    assert lines[6] == ("six", 3) and lines[10] == ("page 10 alone", 13)
    # Null is the least id; a repeated id keeps its other text; blank texts are one group.
    near = key(found["simhash_near_dedup"])
    assert [r for r in near if r[1] == PROSE] == [(0, PROSE)] and (1, ROWS[1][1]) in near
    assert len([r for r in near if not r[1]]) == 1 and len(near) == len(ROWS) - 4
    clean = key(found["decontamination"])
    assert clean == [r for r in all_rows if "one two three" not in r[1]]
    assert found["simhash_near_dedup"].count() and stages["bpe"](spark, docs, str(tmp_path)).count() == len(ROWS)


def test_stages_without_rows(spark, tmp_path):
    docs = tables(spark, tmp_path).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0, name
