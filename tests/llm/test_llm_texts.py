"""Decontamination, quality rules and the Jaccard join against plain versions."""

import random

import pytest
from plain import ODD, groups, hit_words, shingles

from parcelwise.llm import bytewise, jaccard, rules, winnowing

DOCS = "doc_id long, text string, row string, hits int, set binary, signature string, n_words string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, b"", "s", "w") for d, t in rows], DOCS)


def noise(seed, n, words=400):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(words)}" for _ in range(n))


def test_decontamination_equals_plain(spark):
    items = [(1, noise(1, 30)), (2, noise(2, 10)), (3, "Three short words"), (4, "one"), (5, ""), (6, None), (None, noise(3, 12))]
    items += [(10, noise(1, 30)), (1, noise(1, 30)), (7, "the same ten words in a row " * 3)]
    docs = list(ODD)
    for k in range(60):
        a = noise(100 + k, 50).split()
        own = [t for _, t in items if t][k % 7].upper().split()
        cut = own[k % 5 : k % 5 + 9 + k % 4]
        a[k % 40 : k % 40] = cut
        docs.append((1000 + k, ", ".join(a)))
    docs.append((2000, " ".join(t for _, t in items if t) * 40))
    bench = spark.createDataFrame([(i, t, "x", 0) for i, t in items], "item_id long, text string, digest string, size int")
    found = winnowing.decontaminate(frame(spark, docs), bench).collect()
    plain = []
    for d, t in docs:
        n, hit, names = hit_words(t, [("null" if i is None else str(i), x) for i, x in items])
        plain.append((d, n, hit, tuple(sorted(names))))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found), key=str) == sorted(plain, key=str)
    assert winnowing.decontaminate(frame(spark, []), bench).collect() == []
    clean = winnowing.decontaminate(frame(spark, docs), bench.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r.n_hit for r in clean)


def test_every_shared_span_has_a_shared_fingerprint():
    pick = random.Random(5)
    import numpy as np

    for _ in range(200):
        span = np.array([pick.getrandbits(64) for _ in range(winnowing.SPAN)], np.uint64)
        texts = [np.array([pick.getrandbits(64) for _ in range(pick.randrange(20))], np.uint64) for _ in range(4)]
        a = winnowing.fingerprints(np.concatenate((texts[0], span, texts[1])))
        b = winnowing.fingerprints(np.concatenate((texts[2], span, texts[3])))
        assert a[len(texts[0])] == b[len(texts[2])]


def test_rules_on_odd_texts(spark):
    found = rules.judge(frame(spark, ODD)).collect()
    assert len(found) == len(ODD)
    by = {(r.doc_id, r.n_words): r for r in found}
    assert by[5, 40_001].n_repeat_words == 40_000 and by[5, 40_001].base_failed
    assert by[6, 1].word_chars == 200_000
    assert not by[1, 0].kept and not by[2, 0].kept
    assert rules.judge(frame(spark, [])).collect() == []


def test_order_of_rules_changes_no_verdict(spark):
    docs = [(k, t) for k, t in enumerate(["A B C D E F G H I J K L", "a!! " * 3 + noise(1, 12), "$ # % " * 4, noise(2, 30), "x\ny\n" * 9])]
    plain = [not rules.base_failed(d) and not any(r.rejects(d) for r in rules.RULES) for d in _documents(docs)]
    for order in (rules.RULES, rules.RULES[::-1]):
        found = rules.judge(frame(spark, docs), order)
        assert [r.kept for r in found.orderBy("doc_id").collect()] == plain


def _documents(docs):
    import pyarrow as pa

    return list(rules.documents(pa.array([t for _, t in docs])))


def near_copies(seed):
    """Chains, near copies around the threshold, exact copies, shared passages and documents of shared parts alone."""
    pick, out = random.Random(seed), []
    passages = [[f"p{seed}x{k}y{j}" for j in range(60)] for k in range(4)]
    for base in range(12):
        words = [f"b{seed}x{base}y{j}" for j in range(pick.choice([4, 5, 6, 20, 80, 300]))]
        for _ in range(pick.randrange(1, 9)):
            out.append(" ".join(words))
            for _ in range(pick.choice([0, 1, 1, 2, 3])):  # each copy is made from the last
                words = list(words)
                words[pick.randrange(len(words))] = f"c{pick.random()}"
    for k in range(20):
        own = [f"o{seed}x{k}y{j}" for j in range(pick.choice([10, 40, 300]))]
        out.append(" ".join(own + passages[k % 4]))
    for k in range(12):
        out.append(" ".join(sum((passages[j] for j in range(4) if k >> j & 1), [])))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_join_equals_plain(spark, monkeypatch, seed):
    if seed == 2:
        monkeypatch.setattr(jaccard, "ROUNDS", 1)  # leaves more to the regions
    texts = near_copies(seed)
    random.Random(seed).shuffle(texts)
    sets = [shingles(t) for t in texts]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame(spark, list(enumerate(texts)))).collect()}
    assert found == {k: (len(sets[k]), root) for k, root in enumerate(groups(sets))}


@pytest.mark.parametrize("seed", [4, 5])
def test_large_regions_are_dealt_out(spark, monkeypatch, seed):
    """No group has more points than a region may have, though whole cells have; the components stay exact."""
    for name, value in (("ROUNDS", seed - 4), ("REGION_POINTS", 12), ("PAIR_POINTS", 5)):
        monkeypatch.setattr(jaccard, name, value)
    shared = [f"s{j}" for j in range(170)]
    texts = near_copies(seed) + [" ".join(shared + [f"t{k}x{j}" for j in range(18 + k % 9)]) for k in range(60)]
    random.Random(seed).shuffle(texts)
    largest, groups_of, grouped = [], [], jaccard._grouped

    def spy(points, sets):
        rows = points.groupBy("root", "a", "b").count().collect()
        largest.extend(r["count"] for r in rows)
        groups_of.extend((r.a, r.b) for r in rows)
        return grouped(points, sets)

    monkeypatch.setattr(jaccard, "_grouped", spy)
    sets = [shingles(t) for t in texts]
    found = {r.doc_id: r.component_id for r in jaccard.join(frame(spark, list(enumerate(texts)))).collect()}
    assert found == dict(enumerate(groups(sets)))
    if seed == 4:  # no contraction: the 60 documents are one cell
        assert len(set(groups_of)) > 20 and max(largest) <= 24  # blocks are dealt by hash


def test_documents_of_one_template_leave_their_cells(spark, monkeypatch):
    """80 % of the shingles are shared by all and the rest by none, so no two are within the radius."""
    called, solved = [], jaccard._solved
    monkeypatch.setattr(jaccard, "_solved", lambda *a: called.append(a) or solved(*a))
    template = [f"s{j}" for j in range(404)]
    texts = [" ".join(template + [f"t{k}x{j}" for j in range(100)]) for k in range(40)]
    found = jaccard.join(frame(spark, list(enumerate(texts)))).collect()
    assert {r.doc_id: r.component_id for r in found} == {k: k for k in range(40)} and not called


def test_regions_alone_find_every_component():
    import numpy as np
    import pyarrow as pa

    for seed in range(20):
        texts = [t for t in near_copies(seed) if t]
        sets = []
        for low, high, hashes, at in jaccard.shingle_sets(pa.array(texts)):
            sets += [hashes[at[k] : at[k + 1]] for k in range(high - low)]
        region = jaccard._Region(sets, list(range(len(sets))))
        region.solve()
        roots = [region.root(k) for k in range(len(sets))]
        smallest = {r: roots.index(r) for r in roots}
        assert [smallest[r] for r in roots] == groups([shingles(t) for t in texts])
        assert all(np.all(s[1:] > s[:-1]) for s in sets)


def test_jaccard_join_on_odd_texts(spark):
    found = jaccard.join(frame(spark, ODD)).collect()
    assert len(found) == len(ODD)
    ids = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)
    assert (1, 0, 1) in ids and (2, 0, 2) in ids and (None, 0, None) in ids
    assert [i for i in ids if i[0] == 7] == [(7, 7, 7)] * 2
    assert jaccard.join(frame(spark, [])).collect() == []
    assert [r.component_id for r in jaccard.join(frame(spark, [(3, None), (4, "")])).orderBy("doc_id").collect()] == [3, 4]


def test_spans_and_hashes_do_not_depend_on_slices():
    import numpy as np
    import pyarrow as pa

    column = pa.array([t for _, t in ODD] + ["a b", None, "a b"])
    parts = []
    for limit in (1, 7, 1 << 21):
        out = []
        for low, high, data, offsets in bytewise.slices(column, limit):
            starts, ends, rows = bytewise.spans(bytewise.NOT_SPACE[data], offsets)
            out += zip((rows + low).tolist(), bytewise.span_hashes(data, starts, ends).tolist())
        parts.append(out)
    assert parts[0] == parts[1] == parts[2]
    assert np.array_equal([r for r, _ in parts[0]][-4:], [len(ODD), len(ODD), len(ODD) + 2, len(ODD) + 2])
