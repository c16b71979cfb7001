"""The pipeline's near-dedup stage: SimHash by Golay keys, its exact check, and the join for what is left."""

import random

import corpus_pipeline
from corvine.llm import components, similarity_join, simhash_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows():
    rnd = random.Random(21)
    draw = lambda n: [f"w{rnd.randrange(5000)}" for _ in range(n)]
    texts = []
    for _ in range(12):  # near copies at few bits and at many
        base = draw(400)
        texts += [base, [*base, "end"], ["start", *base], base[:-40] + draw(40), draw(60)]
    again = "a b c d e".split() * 200  # the repeats outvote the rest: one fingerprint, but few shingles in common
    texts += [again + draw(30), again + draw(30)]
    rnd.shuffle(texts)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    return [*rows, (500, None), (501, " "), (502, rows[0][1].upper()), (503, "one two"), (504, "two one")]


def _likeness(a, b):
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def _components(nodes, pairs):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    return {x: find(x) for x in nodes}


def _groups(of):
    out = {}
    for x, r in of.items():
        out.setdefault(r, set()).add(x)
    return {frozenset(g) for g in out.values()}


def test_simhash_links_first_then_the_join(spark, monkeypatch):
    rows = _rows()
    tried, linked, met = [], [], []
    checked, links = similarity_join._checked, simhash_dedup.links

    def check(docs, nodes, pairs):
        tried.append({(r.x, r.y) for r in pairs.collect()})
        out = checked(docs, nodes, pairs)
        linked.append({(r.a, r.b) for r in out.collect()})
        return out

    def link(distinct, *more):
        met.append(distinct.count())
        return links(distinct, *more)

    monkeypatch.setattr(similarity_join, "_checked", check)
    monkeypatch.setattr(simhash_dedup, "links", link)
    out = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame([(*r, "en", "s", 0) for r in rows], SCHEMA), "").collect()

    sets = {similarity_join.set_id(s): set(s.tolist()) for _, t in rows for s in [similarity_join.shingle_set(t)]}
    prints = {}
    for _, t in rows:
        prints.setdefault(similarity_join.set_id(similarity_join.shingle_set(t)), set()).add(simhash_dedup.fingerprint(t, 5))
    bits = lambda a, b: min((x ^ y).bit_count() for x in prints[a] for y in prints[b])
    pairs = [(a, b) for a in sets for b in sets if a < b]
    near = [p for p in pairs if bits(*p) <= 3]
    alike = [p for p in pairs if _likeness(sets[p[0]], sets[p[1]]) >= 0.8]

    # The fingerprints of all sets meet by the Golay keys, and the exact check drops what is only near in bits.
    assert met == [len(set().union(*prints.values()))]
    assert any(p not in alike for p in near) and any(p not in near for p in alike)
    by_print = _components(sets, [p for p in near if p in alike])
    assert linked[0] <= set(alike) and _groups(_components(sets, linked[0])) == _groups(by_print)
    assert linked[0] < tried[0]
    # The join tries only sets that SimHash didn't bring together, and what it finds makes the components whole.
    assert linked[1] and all(by_print[a] != by_print[b] for a, b in tried[1])
    whole = _components(sets, alike)
    assert _groups(_components(sets, set().union(*linked))) == _groups(whole)
    least = {}
    for i, t in rows:
        r = whole[similarity_join.set_id(similarity_join.shingle_set(t))]
        least[r] = min(i, least.get(r, i))
    assert sorted(r.doc_id for r in out) == sorted(least.values())


def test_folded_is_the_fingerprint():
    for text in [t for _, t in _rows()] + ["x " * 40000, "one"]:
        assert simhash_dedup.folded(similarity_join.shingles(text)) == simhash_dedup.fingerprint(text, 5)


def test_components_of_few_edges(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(-300, 300), rnd.randrange(-300, 300)) for _ in range(250)] + [(7, 7), (900, 901), (901, 900)]
    table = spark.createDataFrame(edges, "a long, b long").repartition(5)
    rounds, one = (sorted(map(tuple, components.connected_components(table, few).collect())) for few in (0, len(edges)))
    assert rounds == one and len(one) > 100
    assert components.connected_components(table.limit(0), 10).collect() == []
