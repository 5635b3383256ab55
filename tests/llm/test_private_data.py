import random
import re
import time

import pytest

from ledgerline.llm import private_data

from .conftest import ODD_ROWS

#: The base patterns as given.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": "[0-9]([\x20-]?[0-9])+", "phone": "\\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        odd, even = digits[-1::-2], digits[-2::-2]
        return 12 <= len(digits) <= 19 and (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    return {k: [m.span() for m in re.finditer(p, text) if passes(k, m[0])] for k, p in PATTERNS.items()}


@pytest.mark.parametrize("alphabet", ["ab@.-1 +", "0123456789.", "0123 -+()", "a1@. _%", "4111 -"])
def test_base_spans_as_plain_patterns(alphabet):
    rnd = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        assert private_data.base_spans(text) == plain(text)


@pytest.mark.parametrize(("text", "kind", "want"), [
    ("write john dot doe [at] mail (dot) com today", "email", "john dot doe [at] mail (dot) com"),
    ("write jane at example dot com today", "email", "jane at example dot com"),
    ("mail jоhn@exаmple.com!", "email", "jоhn@exаmple.com"),
    ("call plus one five five five one two three four five six seven.", "phone", "plus one five five five one two three four five six seven"),
    ("é ４１１１ １１１１ １１１１ １１１１ é", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("from one nine two dot one six eight point zero point one", "ip", "one nine two dot one six eight point zero point one"),
])
def test_disguises_map_back_to_source(text, kind, want):
    base, added = private_data.all_spans(text)
    assert not base[kind] and [text[a:b] for a, b in added[kind]] == [want]


@pytest.mark.parametrize("text", ["look at the dot here", "one or two of them, at three", "Der Brief kam an einem Punkt an.", "a.b [x] (y)", "at dot com"])
def test_prose_stays_clean(text):
    base, added = private_data.all_spans(text)
    assert not any(base.values()) and not any(added.values())


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "a." * 150_000 + "@", "one " * 50_000, "1 " * 100_000, "+1" + " " * 200_000, "x [at] " * 40_000])
def test_long_runs_take_linear_time(text):
    start = time.thread_time()
    private_data.all_spans(text)
    assert time.thread_time() - start < 5


def test_mask_and_odd_rows(spark, odd, frame, empty):
    found, name = private_data.find(odd)
    assert name != "spans" and set(found.columns) == {*odd.columns, name} and found.count() == len(ODD_ROWS)
    assert not any(r[name] for r in found.collect())
    mail = frame([(1, "to a@b.co and +1 (743) 555-3824, 8.8.8.8", "s"), (2, None, "s")])
    masked, _ = private_data.find(mail, masked="[{}]")
    assert {r.doc_id: r.text for r in masked.collect()} == {1: "to [EMAIL] and [PHONE], [IP]", 2: None}
    assert private_data.find(empty)[0].collect() == []
