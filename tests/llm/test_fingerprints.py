import hashlib
from collections import Counter

import numpy as np

from ledgerline.llm import fingerprints

from .conftest import ODD_ROWS


def jaccard(a, b):
    a, b = (Counter(t.lower().split() or [""]) for t in (a, b))
    return sum((a & b).values()) / sum((a | b).values())


def test_collision_rate_is_generalised_jaccard(spark):
    """Over many pairs of bags of unlike words and weights, the mean error is within its deviation."""
    rnd = np.random.default_rng(3)
    rows, want = [], {}
    for i in range(120):
        words = [f"w{i}x{k}" for k in range(12)]
        a, b = ({w: int(rnd.integers(0, 6)) for w in words} for _ in range(2))
        want[i] = sum(min(a[w], b[w]) for w in words) / max(1, sum(max(a[w], b[w]) for w in words))
        rows += [(i, s, w, n) for s, bag in enumerate((a, b)) for w, n in bag.items() if n]
    terms = spark.createDataFrame(rows, "pair int, side int, term string, weight int")
    signed = fingerprints.signatures(terms, ["pair", "side"], "term", "weight", 64)
    both = signed.where("side = 0").withColumnRenamed("fingerprint", "a").join(
        signed.where("side = 1").withColumnRenamed("fingerprint", "b"), "pair")
    found = both.select("pair", fingerprints.likeness(both["a"], both["b"], 64).alias("p")).collect()
    errors = np.array([r.p - want[r.pair] for r in found])
    assert len(errors) == 120 and abs(errors.mean()) < 0.02 and errors.std() < 0.09


def test_edited_texts_and_odd_rows(odd):
    found = fingerprints.edit_and_fingerprint(odd).collect()
    assert len(found) == len(ODD_ROWS)
    distinct = {(i, t or "") for i, t, _ in ODD_ROWS}
    assert {(r.doc_id, r.n_chars) for r in found} == {(i, len(t)) for i, t in distinct}
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    by_text = {}
    for r in found:
        by_text.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert by_text[3, 3] == {r.fingerprint for r in found if r.n_chars == 3 and r.doc_id == 3} and len(by_text[3, 3]) == 1
    blank = {r.fingerprint for r in found if r.n_chars == 0}
    assert len(blank) == 1


def test_next_text_in_descending_order(frame):
    texts = {1: "aaaa bbbb", 5: "cc", 9: "dddd eeee ffff gggg"}
    found = {r.doc_id: r for r in fingerprints.edit_and_fingerprint(frame([(i, t, "s") for i, t in texts.items()])).collect()}
    for i, j in ((9, 5), (5, 1), (1, 9)):
        n = len(texts[i])
        edited = texts[i][:n - n // 2] + texts[j][:n // 2]
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i].near_next == 0.0
    alone = fingerprints.edit_and_fingerprint(frame([(1, "one two", "s")])).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"one one").hexdigest()


def test_empty_table(empty):
    assert fingerprints.edit_and_fingerprint(empty).collect() == []
