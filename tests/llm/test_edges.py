"""Every operator and pipeline stage on nulls, empty and long texts, repeats, empty tables and clashing columns."""

import os

import pytest

import corpus_pipeline
from docloom.llm import decontamination, html_blocks, language_id, license_scan, line_dedup, mixing, quality_rules, simhash, suffix_tree, toxicity

# columns that the operators use inside, given as further columns of the input
CLASH = "id long, key long, c long, block long, ids string, n long, fp long, root long, node long, mark long, size long, taken long, shard long, target string, words string, failed long, score double, text_ string, held_out string, count long, w string, first string, gone string, component_id string"
CLASH_NAMES = [f.split()[0] for f in CLASH.split(", ")]
DOC = "doc_id long, text string, lang string, source string, n_chars long, " + CLASH

LONG = "the long text goes on and on with words, " * 3000
TEXTS = [
    (1, "A plain text of a few words that is long enough to be a line.\nSecond line of the same text here.", "en", "a"),
    (2, "A plain text of a few words that is long enough to be a line.\nSecond line of the same text here.", "en", "a"),
    (3, None, "en", "b"),
    (4, "", "fr", None),
    (5, "   \n\t\n ", None, "b"),
    (6, LONG, "en", "a"),
    (7, "12345 67890 !!! ###", "de", None),
    (8, "You are an idiot and a moron, you idiot. Ünïcödé \U0001f600 text", "en", "c"),
    (8, "You are an idiot and a moron, you idiot. Ünïcödé \U0001f600 text", "en", "c"),
    (8, "Same id, other text", "en", "c"),
    (None, "No id at all, but a text with several words in it", None, None),
    (None, None, None, None),
]


def documents(spark, rows):
    def cast(i):
        return {n: (None if i % 2 else 1.0) if n == "score" else (None if i % 3 else "x") if n in ("ids", "target", "words", "text_", "held_out", "w", "first", "gone", "component_id") else i for n in CLASH_NAMES}

    data = [(d, t, lang, s, len(t) if t is not None else None, *cast(i).values()) for i, (d, t, lang, s) in enumerate(rows)]
    return spark.createDataFrame(data, DOC)


@pytest.fixture(params=["edges", "empty"])
def docs(request, spark):
    return documents(spark, TEXTS if request.param == "edges" else [])


def labels(spark, empty=False):
    rows = [] if empty else [(1, 1, 0), (2, 1, 0), (8, 0, 1), (8, None, None), (None, 1, 1), (6, 1, None), (99, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def benchmark(spark, empty=False):
    rows = [] if empty else [(1, "several words in it"), (1, "long enough to be a line second line of the same text"), (2, None), (3, ""), (None, "short")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_suffix_tree(spark, docs):
    out = suffix_tree.score_documents(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        assert r.n_tokens >= 1 and r.n_known <= r.n_tokens and r.score <= 0 and r.base_score <= 0
        if r.doc_id == 3:
            assert r.n_tokens == 1


def test_simhash(spark, docs):
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == docs.count()
    if out:
        by_id = {r.doc_id: r for r in out}
        assert by_id[1].component_id == by_id[2].component_id == 1
        assert {by_id[i].fp for i in (3, 4, 5)} == {0} and {by_id[i].component_id for i in (3, 4, 5)} == {3}
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == (['1', '3', '6', '7', '8', '8', 'None', 'None'] if out else [])


def test_toxicity(spark, docs):
    for empty in (False, True):
        out = toxicity.score_documents(docs, labels(spark, empty)).collect()
        assert len(out) == docs.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
        assert toxicity.drop_toxic(docs, labels(spark, empty)).columns == docs.columns


def test_line_dedup(spark, docs):
    rows = line_dedup.near_lines(docs).collect()
    assert {(r.doc_id, r.line_no) for r in rows if r.first} <= {(1, 0), (1, 1), (6, 0), (7, 0), (8, 0), (None, 0)}
    kept = line_dedup.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    by_id = {r.doc_id: r for r in kept.collect()}
    assert kept.count() == docs.count()
    if by_id:
        assert by_id[1].text == TEXTS[0][1] and by_id[2].text == "" and by_id[2].n_chars == 0
        assert by_id[3].text is None and by_id[5].text == TEXTS[4][1] and by_id[6].text == LONG


def test_line_dedup_of_repeated_ids(spark):
    """Rows that share an id, or have none, lose only what stands elsewhere; order of equal ids follows the text's hash."""
    repeated, unique, other = "a line that stands in two of the rows", "a line that stands in one row only", "another line of its own, nowhere else"
    rows = [(7, repeated), (7, unique), (3, repeated), (None, other + "\n" + repeated), (None, unique + " too, but it is longer")]
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in got) == sorted(["", unique, repeated, other, unique + " too, but it is longer"])


def test_line_dedup_of_very_many_lines(spark):
    lines = [f"line number {i} of a long text" for i in range(20_000)]
    rows = [(1, "\n".join(lines[:10_000])), (2, "\n".join(lines))]
    options = line_dedup.LineOptions(edit_chars=1000)  # equal lines only
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), options).collect()}
    assert got[1] == rows[0][1] and got[2] == "\n".join(lines[10_000:])


def test_quality_rules(spark, docs):
    marks = quality_rules.ledger(docs)
    rows = marks.collect()
    assert len(rows) == docs.count()
    few = 1 << list(quality_rules.RULES).index("few_words")
    assert all(r.failed & few for r in rows if r.doc_id in (3, 4, 5))
    for p in quality_rules.POLICIES:
        kept = quality_rules.apply_policy(marks, p).collect()
        mask = quality_rules.mask_of(quality_rules.POLICIES[p])
        assert all(r.kept == (r.failed & mask == 0) for r in kept)
        for a in quality_rules.ablation(marks, p).collect():
            bit = quality_rules.mask_of([a.rule])
            assert a.failing == sum(bool(r.failed & bit) for r in kept)
            assert a.alone == sum(r.failed & mask == bit for r in kept)


def test_language_id(spark, docs):
    out = language_id.identify(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        assert 0 <= r.score <= 1
        if r.doc_id in (3, 4, 5, 7):
            assert r.lang_pred == "und"


def test_decontamination(spark, docs):
    for empty in (False, True):
        found = decontamination.find_leaks(docs, benchmark(spark, empty)).collect()
        assert {(r.doc_id, r.item_id) for r in found} == ({(1, 1), (2, 1)} if docs.count() and not empty else set())
        kept = decontamination.drop_leaked(docs, benchmark(spark, empty))
        assert kept.columns == docs.columns and kept.count() == docs.count() - len(found)


def test_mixing(spark, docs):
    out = mixing.mix(docs).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size + 1e-9 for r in out)
    assert all(r.taken == 0 for r in out if r.size == 0)
    assert mixing.mixed_documents(docs).columns[: len(docs.columns)] == docs.columns


def test_license_scan(spark, docs):
    out = license_scan.scan(docs).collect()
    assert len(out) == docs.count()
    assert all(r.n_base == 0 and r.first_word is None for r in out)


def test_html(spark):
    rows = [(1, "u", None, 5), (2, None, "", 6), (None, "u", "<article><p>A", 7), (1, "u", "<p>&amp;&#65;</p>" * 500, 8), (3, "u", "plain < text > no tags", 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    out = html_blocks.extract(pages).collect()
    assert len(out) == 5 and all(r.n_chars == len(r.text) for r in out)
    assert {r.text for r in out if r.page_id == 2} == {""}
    assert html_blocks.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages(spark, tmp_path, empty):
    sf = str(tmp_path)
    plain = documents(spark, [] if empty else TEXTS).select("doc_id", "text", "lang", "source", "n_chars")
    for name, df in (("documents", plain), ("labels", labels(spark, empty)), ("benchmark", benchmark(spark, empty))):
        df.write.parquet(os.path.join(sf, f"{name}.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, plain, sf)
        assert out.columns == plain.columns and out.dtypes == plain.dtypes, name
        out.collect()
    assert corpus_pipeline.run(spark, sf).columns[:5] == plain.columns
