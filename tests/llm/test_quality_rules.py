import random
import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerline.llm import quality_rules

from .conftest import ODD_ROWS


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures(frame):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(["a", "b", "c ", " ", "\n", "#", "é", "\t", "a b c d e ", "x\n", "\x1c", "\x0b"]) for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    judged, name = quality_rules.judge(frame([(i, t, "s") for i, t in enumerate(texts)]))
    for r in judged.collect():
        q = r[name]
        want = plain(texts[r.doc_id])
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == want
        assert q.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (q.base_failed and q.kept)


def test_verdicts(frame):
    good = " ".join(f"the word{i} of a thing{i} is in that place{i}" for i in range(20))
    rows = [(1, good, "s"), (2, "### " * 30 + "x", "s"), (3, " ".join(f"zzz{i}" for i in range(60)), "s"), (4, "few words", "s"),
            (5, "\n".join(["a line that comes again"] * 30), "s"), (6, " ".join(f"{w}***" for w in good.split()), "s")]
    judged, name = quality_rules.judge(frame(rows))
    broken = {r.doc_id: r[name].broken for r in judged.collect()}
    assert broken[1] == [] and "stop_words" in broken[3] and broken[4] == ["few_words"] and "repeated_lines" in broken[5] and "symbols" in broken[6]
    assert [r.doc_id for r in judged.where(F.col(name)["kept"]).collect()] == [1]


def test_odd_rows(odd, empty):
    judged, name = quality_rules.judge(odd)
    assert name != "quality" and set(judged.columns) == {*odd.columns, name}
    found = sorted(str((r.doc_id, r[name].n_words)) for r in judged.collect())
    assert found == sorted(str((i, plain(t)[0])) for i, t, _ in ODD_ROWS)
    assert quality_rules.judge(empty)[0].collect() == []
