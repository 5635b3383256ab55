import random
from collections import Counter, defaultdict

import pytest

from ledgerline.llm import pfair_mix

from .conftest import ODD_ROWS


@pytest.mark.parametrize("seed", range(6))
def test_schedule_stays_within_one_block(seed):
    rnd = random.Random(seed)
    slots = pfair_mix.shares({f"s{i}": rnd.random() ** 3 + 1e-4 for i in range(rnd.randint(1, 40))})
    assert sum(slots.values()) == pfair_mix.PERIOD and min(slots.values()) >= 1
    places = pfair_mix.schedule(slots)
    order = sorted((t, s) for s, ts in places.items() for t in ts)
    assert [t for t, _ in order] == list(range(pfair_mix.PERIOD))
    count = Counter()
    for t, s in order:
        count[s] += 1
        assert all(abs(count[x] - (t + 1) * slots[x] / pfair_mix.PERIOD) < 1 for x in slots)


def check_mix(rows, weights, block):
    """Every slot is taken once; blocks of a source in order; until a source runs out, less than one block off."""
    by_slot, blocks = {}, defaultdict(dict)
    for source, number, position in rows:
        assert by_slot.setdefault(position // block, (source, number)) == (source, number)
        blocks[source].setdefault(number, position // block)
    assert sorted(by_slot) == list(range(len(by_slot))) and len({p for _, _, p in rows}) == len(rows)
    for numbers in blocks.values():
        assert [s for _, s in sorted(numbers.items())] == sorted(numbers.values()) and sorted(numbers) == list(range(len(numbers)))
    active, start, used = {s: w for s, w in weights.items() if w > 0}, 0, Counter()
    while active:
        slots, count, t = pfair_mix.shares(active), Counter(), 0
        while all(used[s] < len(blocks[s]) for s in active):
            source = by_slot[start + t][0]
            used[source] += 1
            count[source] += 1
            t += 1
            assert all(abs(count[s] - t * slots[s] / pfair_mix.PERIOD) < 1 for s in active)
        start += t
        active = {s: w for s, w in active.items() if used[s] < len(blocks[s])}


@pytest.mark.parametrize("weights", [None, {"a": 5, "b": 1, "c": 3}, {"a": 1, "d": 2}])
def test_mix(frame, monkeypatch, weights):
    monkeypatch.setattr(pfair_mix, "BUCKET", 50)
    sizes = {"a": 900, "b": 333, "c": 77, "d": 5, None: 41}
    rows = [(i, "t", s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = frame(rows)
    mixed, (block, position) = pfair_mix.mix(docs, weights=weights, block=4)
    assert (block, position) != ("block", "position") and set(mixed.columns) == {*docs.columns, block, position}
    found = [(r.source, r[block], r[position]) for r in mixed.collect()]
    assert Counter(s for s, _, _ in found) == sizes
    target = {s: n ** 0.5 for s, n in sizes.items()} if weights is None else {s: weights.get(s, 0) for s in sizes}
    check_mix(found, target, 4)


def test_odd_rows_and_empty_table(odd, empty):
    mixed, names = pfair_mix.mix(odd, order_cols=("doc_id", "text"))
    assert mixed.count() == len(ODD_ROWS) and mixed.select(names[1]).distinct().count() == len(ODD_ROWS)
    assert pfair_mix.mix(empty)[0].collect() == []


def test_too_many_sources(frame):
    with pytest.raises(ValueError):
        pfair_mix.mix(frame([(i, "t", f"s{i}") for i in range(pfair_mix.MOST_SOURCES + 1)]))


@pytest.mark.parametrize("sources", [20, 200])
def test_deviation_from_the_target_weights_themselves(frame, sources):
    """One source has half of the weight; after any number of slots all are less than a block off."""
    sizes = {f"s{i:03}": 1800 if i == 0 else 40 for i in range(sources)}
    target = {s: 0.5 if s == "s000" else 0.5 / (sources - 1) for s in sizes}
    rows = [(i, "t", s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    mixed, (_, position) = pfair_mix.mix(frame(rows), weights=target, block=1)
    order = [s for _, s in sorted((r[position], r.source) for r in mixed.collect())]
    assert len(order) == len(rows)
    total, used = sum(target.values()), Counter()
    for t, s in enumerate(order, 1):
        used[s] += 1
        assert all(abs(used[x] - t * w / total) < 1 + 1e-9 for x, w in target.items())
        if used[s] == sizes[s]:
            break
    assert t > 700


def test_long_schedules_stay_within_one_block():
    weights = [7.3, *[0.1 + i / 7 for i in range(20)]]
    total, used = sum(weights), [0] * len(weights)
    for t, (s, block) in enumerate(pfair_mix.slots_of([10**9] * len(weights), weights), 1):
        assert block == used[s]
        used[s] += 1
        if t % 997 == 0:
            assert all(abs(n - t * w / total) < 1 for n, w in zip(used, weights))
        if t == 200_000:
            break


def test_texts_are_shuffled_once_for_the_numbers(frame):
    mixed, _ = pfair_mix.mix(frame([(i, f"text {i}", "ab"[i % 2]) for i in range(40)]), order_cols=("doc_id", "text"))
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    numbers, dealt = plan.split("RepartitionByExpression", 1)
    assert "text AS _w1#" in numbers and "AS _w1#" not in dealt  # what the window orders by is taken out above the shuffle
