import random

from vistaloom.llm import mixing


def slow_targets(sizes):
    names = sorted((k for k in sizes if k is not None)) + ([None] if None in sizes else [])
    weight = {n: mixing.WEIGHTS[i % 3] for i, n in enumerate(names)}
    target, left, open_ = {}, mixing.SHARE * sum(sizes.values()), set(names)
    while open_:
        over = {n for n in open_ if left * weight[n] / sum(weight[x] for x in open_) > 2 * sizes[n]}
        if not over:
            return target | {n: left * weight[n] / sum(weight[x] for x in open_) for n in open_}
        target |= {n: 2.0 * sizes[n] for n in over}
        left -= sum(target[n] for n in over)
        open_ -= over
    return target


def table(make, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.choice([0, 1, 5, 400])) or None, rng.choice(["b", "a", "a", "c", None]), 7) for i in range(400)]
    rows += [(None, "x y", "a", 7), (None, "x y", "a", 7), (3, None, "empty", 7), (4, "  ", "empty", 7)]
    return make(rows, "doc_id long, text string, source string, target int")


def test_targets_and_limits(make):
    got = mixing.mix(table(make)).collect()
    assert len(got) == 404
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    aims = slow_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - aims[r.source]) < 1e-6 * max(1, r.target)
    for s, t in aims.items():
        assert abs(taken[s] - t) <= 3 + 0.001 * t


def test_reruns_agree(make):
    a = sorted(map(str, mixing.mix(table(make)).collect()))
    assert a == sorted(map(str, mixing.mix(table(make).repartition(7)).collect()))


def test_empty_and_wordless(make):
    ddl = "doc_id long, text string, source string"
    assert mixing.mix(make([], ddl)).count() == 0
    (r,) = mixing.mix(make([(1, "", None)], ddl)).collect()
    assert (r["size"], r.target, r.taken) == (0, 0.0, 0)


def test_small_sources_come_near_their_targets_at_any_size(make):
    rows = [(i, "w " * 50, f"big{i % 3}") for i in range(600)] + [(i, "w " * n, f"s{i}") for i, n in enumerate([1, 3, 20, 35, 40, 70, 400], 1000)]
    got = mixing.mix(make(rows, "doc_id long, text string, source string"), 64).collect()
    aim, taken = {}, {}
    for r in got:
        aim[r.source] = r.target
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    for s, t in aim.items():
        assert abs(taken[s] - t) <= 1 + 0.01 * t, (s, t, taken[s])


def test_slots_grow_with_the_input(make):
    rows = [("a", 200_000_000, 150_000_000.0), ("b", 100_000_000, 150_000_000.0), ("c", 100_000, 150_000.0)]
    aims = make(rows, "source string, source_size long, target double")
    for r in mixing.drawn(aims, 200_000_000).collect():
        assert abs(r._passes * r.source_size + r._rest - r.target) <= 0.01 * r.target, r
