import random

import numpy as np
import xxhash

from ledgerline.llm import simhash
from ledgerline.llm.components import components

from .conftest import ODD_ROWS


def plain_fingerprint(text, n):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(max(1, len(words) - n + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def near_values(seed):
    """Groups of values around a few centers, some long."""
    rnd, found = random.Random(seed), set()
    for size in (1, 2, 5, 60):
        for _ in range(4):
            center = rnd.getrandbits(63)
            for _ in range(size):
                x = center
                for _ in range(rnd.randint(0, 5)):
                    x ^= 1 << rnd.randrange(63)
                found.add(x)
    return found


def test_links_keep_components_whatever_the_longest_list(spark):
    values = near_values(1)
    want = plain_components(values, 3)
    frame = spark.createDataFrame([(x,) for x in values], "print long")
    for longest in (256, 1):  # paired up, and spread
        roots = {r.node: r.root for r in components(simhash.links_within(frame, 3, longest)).collect()}
        assert {v: roots.get(v, v) for v in values} == want


def test_all_pairs_within_radius_are_linked(spark):
    values = sorted(near_values(2))
    frame = spark.createDataFrame([(x,) for x in values], "print long")
    found = {(r.u, r.v) for r in simhash.links_within(frame).collect()}
    assert found == {(a, b) for i, b in enumerate(values) for a in values[:i] if (a ^ b).bit_count() <= 3}


def test_chains_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901), (7, 7)], "u long, v long")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {i: 0 for i in range(301)} | {900: 900, 901: 900}


def test_odd_rows(odd, empty):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == len(ODD_ROWS)
    prints = {(i, plain_fingerprint(t, 3)) for i, t, _ in ODD_ROWS}
    assert {(r.doc_id, r.fingerprint % (1 << 64)) for r in found} == prints
    values = {p for _, p in prints}
    roots = plain_components(values, 3)
    least = {}
    for i, p in prints:
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    assert all(r.component_id == least.get(roots[r.fingerprint % (1 << 64)]) for r in found)
    assert simhash.near_duplicates(empty).collect() == [] and simhash.keep_one(empty).collect() == []


def test_keep_one_of_each_group(frame):
    rnd = random.Random(7)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    rows, groups = [], {}
    for g in range(25):
        base = words(150 + 10 * g)
        for c in range(rnd.choice([1, 2, 5])):
            text = list(base)
            for _ in range(2 * (c > 0)):  # two changed words: a similarity of about 0.9
                text[rnd.randrange(len(text))] = "changed"
            groups[len(rows)] = g
            rows.append((len(rows), " ".join(text), "s"))
    half = words(200)
    for k in range(3):  # a shared passage is no copy
        groups[len(rows)] = 100 + k
        rows.append((len(rows), " ".join(half[:100] + words(100)), "s"))
    rows += [rows[0], rows[0], (None, rows[0][1], None)]
    kept = [r.doc_id for r in simhash.keep_one(frame(rows)).collect()]
    first = {}
    for i, g in sorted(groups.items()):
        first.setdefault(g, i)
    assert sorted(kept) == sorted(first.values())


def test_keep_one_on_odd_rows(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    found = [r.doc_id for r in kept.collect()]
    assert len(found) == 6 and set(found) == {1, 3, 4, 6, 7, None}


def test_long_fingerprints_show_similarity():
    rnd = np.random.default_rng(1)
    for similarity in (0.8, 0.9):
        off = []
        for _ in range(30):
            both = rnd.integers(0, 1 << 63, 600, np.uint64)
            n = round(len(both) * (1 - similarity) / (1 + similarity))
            other = np.concatenate([both[n:], rnd.integers(0, 1 << 63, n, np.uint64)])
            a, b = (np.frombuffer(simhash.long_fingerprint(x), np.uint8) for x in (both, other))
            off.append(int(np.bitwise_count(a ^ b).sum()) - simhash.most_bits(similarity))
        assert abs(np.mean(off)) < 12


def plain_kept(rows, similarity=0.8):
    """Ids of rows without a similar one before them in their component, over all pairs."""
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if both >= similarity * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [rows[i][0] for i in range(len(rows)) if find(i) == i]


def test_every_pair_at_the_threshold_is_found(frame):
    """Pairs of a similarity of just 0.8 and just below, far apart among texts that share a passage."""
    rnd = random.Random(11)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passage, bases, rows = words(60), [], []
    for _ in range(120):
        bases.append(words(60) + passage + words(60))
    changed = [list(b) for b in bases]
    for k, text in enumerate(changed):
        at = rnd.randrange(10, 30)
        text[at:at + 15 + k % 3] = words(15 + k % 3)  # 19 to 21 shingles of 176
    rows = [(i, " ".join(t), "s") for i, t in enumerate(bases + changed)]
    want = plain_kept(rows)
    assert 120 < len(want) < 240
    assert sorted(r.doc_id for r in simhash.keep_one(frame(rows)).collect()) == want


def test_no_link_without_the_texts(frame, monkeypatch):
    """Fingerprints that claim too much join nothing: here all are equal."""
    monkeypatch.setattr(simhash, "long_fingerprint", lambda hashes: bytes(simhash.LONG_BYTES))
    rnd = random.Random(5)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    rows = []
    for k in range(12):  # 25 shingles; the second shares 22 of them (0.786), the third 23 (0.85)
        text = words(29)
        rows += [(3 * k + i, " ".join(text[:29 - n] + words(n)), "s") for i, n in enumerate((0, 3, 2))]
    kept = sorted(r.doc_id for r in simhash.keep_one(frame(rows)).collect())
    assert kept == plain_kept(rows) and {3 * k + 1 for k in range(12)} <= set(kept)


def test_a_large_group_below_the_threshold_hardly_meets(frame, monkeypatch):
    """Texts of one base that each change 22 of 180 words, and pairs at 0.8 among them."""
    met = []
    monkeypatch.setattr(simhash, "met_pairs", lambda *args, pairs=simhash.met_pairs: met.append(pairs(*args).count()) or pairs(*args))
    for n in (100, 300):
        rnd = random.Random(n)
        words = lambda k: [f"w{rnd.randrange(10**6)}" for _ in range(k)]
        base, texts = words(180), []
        for _ in range(n):
            at = rnd.randrange(150)
            texts.append(base[:at] + words(22) + base[at + 22:])
        for k in range(8):
            texts.append(texts[k][:3] + words(12) + texts[k][15:])
        rows = [(i, " ".join(t), "s") for i, t in enumerate(texts)]
        want = plain_kept(rows)
        assert sorted(r.doc_id for r in simhash.keep_one(frame(rows)).collect()) == want and n - 5 < len(want) <= n + 8
    assert all(pairs < 0.02 * n * n for pairs, n in zip(met, (100, 300)))
