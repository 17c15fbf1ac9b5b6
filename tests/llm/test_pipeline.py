"""The corpus pipeline, stage by stage, against brute force."""

import itertools

import corpus_pipeline
from docloom.llm import decontamination as dc
from docloom.llm import line_dedup, simhash, toxicity
from docloom.llm.common import read, stored


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def joined(items, pairs):
    parent = {i: i for i in items}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


def test_stages(spark, sf):
    df = read(spark, sf, "documents")
    rows = [by_id(df)]
    for name, stage in corpus_pipeline.STAGES:
        df = stored(stage(spark, df, sf), f"test-{name}")
        rows.append(by_id(df))
    start, clean, lined, single, free, mixed = rows

    score = by_id(toxicity.op3_toxicity_grammar(spark, sf))
    assert set(clean) == {d for d in start if not score[d].predicted} and len(clean) < len(start)
    assert all(clean[d] == start[d] for d in clean)

    o = line_dedup.LineOptions()
    places = {(d, i): s for d in clean for i, s in enumerate(line_dedup.lines_of(clean[d].text)) if len(s) >= o.min_chars}
    long = sorted({s for s in places.values() if len(s) >= o.edit_chars}, key=len)
    near = []
    for i, a in enumerate(long):
        near += [(a, b) for b in itertools.takewhile(lambda b: len(b) <= len(a) + o.edits, long[i + 1 :])]
    d = line_dedup.within([a for a, _ in near], [b for _, b in near], o.edits)
    of = joined(set(places.values()), [p for p, e in zip(near, d) if e <= o.edits])
    first = {}
    for p in sorted(places):
        first.setdefault(of[places[p]], p)
    assert set(lined) == set(clean)
    for doc, r in lined.items():
        kept = [s for i, s in enumerate(clean[doc].text.split("\n")) if (doc, i) not in places or first[of[places[doc, i]]] == (doc, i)]
        assert r.text == "\n".join(kept) and r.n_chars == len(r.text)

    fp = {doc: simhash.fingerprint(r.text) for doc, r in lined.items()}
    linked = [(a, b) for a, b in itertools.combinations(fp, 2) if (fp[a] ^ fp[b]).bit_count() <= 3]
    group = joined(fp, linked)
    assert set(single) == {doc for doc in fp if group[doc] == doc}

    items = [dc.normal(r.text) for r in read(spark, sf, "benchmark").collect()]
    assert set(free) <= set(single)
    assert not [doc for doc, r in free.items() if any(b in dc.normal(r.text) for b in items)]
    leaked = {r.doc_id for r in dc.find_leaks(read(spark, sf, "documents"), read(spark, sf, "benchmark")).collect()}
    assert set(single) - set(free) <= leaked

    assert set(mixed) <= set(free)
    assert all(0 < r.mix_taken <= 2 * r.mix_size for r in mixed.values())
    taken, size = sum(r.mix_taken for r in mixed.values()), sum(len(r.text.encode().split()) for r in free.values())
    assert abs(taken - 1.5 * size) < 0.05 * size
    assert by_id(corpus_pipeline.run(spark, sf)).keys() == mixed.keys()
