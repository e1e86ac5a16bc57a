import pytest

from clinspark.llm import mixing


def sizes(df):
    return {r["doc_id"]: r for r in df.collect()}


def fill(source_sizes, weights=(1, 2, 3), most=3):
    """Targets by handing out what is left over until nobody is above the limit."""
    names = sorted(source_sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(source_sizes.values())), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * source_sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        out |= {s: float(most * source_sizes[s]) for s in over}
        left -= sum(most * source_sizes[s] for s in over)
        open_ -= over
    return out


ROWS = (
    [(i, "w " * (1 + i % 7), "en", "big") for i in range(3000)]
    + [(5000 + i, "x y", "en", "small") for i in range(5)]
    + [(6000 + i, "one two three", "en", None) for i in range(50)]
    + [(7000, "", "en", "empty"), (7001, None, "en", "empty"), (7002, "one long " * 400, "en", "a")]
)


def test_targets_and_taken_words(docs):
    found = mixing.mix(docs(*ROWS)).collect()
    assert len(found) == len(ROWS)
    source = {r[0]: r[3] for r in ROWS}
    words = {}
    for doc_id, text, _, name in ROWS:
        words[name] = words.get(name, 0) + len((text or "").split())
    wanted = fill(words)
    taken = {}
    for r in found:
        name = source[r["doc_id"]]
        assert r["source_size"] == words[name]
        assert r["target"] == pytest.approx(wanted[name])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[name] = taken.get(name, 0) + r["taken"]
    longest = {}
    for r in found:
        longest[source[r["doc_id"]]] = max(longest.get(source[r["doc_id"]], 0), r["size"])
    for name, target in wanted.items():
        assert abs(taken[name] - target) <= longest[name] / 2 + 1e-6


def test_reruns_and_other_partitionings_agree(docs):
    frame = docs(*ROWS)
    one = sorted(map(tuple, mixing.mix(frame).collect()))
    assert one == sorted(map(tuple, mixing.mix(frame.repartition(7)).collect()))
    other = sorted(map(tuple, mixing.mix(frame, seed="other").collect()))
    assert one != other


def test_many_sources(spark):
    import random

    rng = random.Random(3)
    given = {f"s{i}": rng.randint(0, 1000) for i in range(40)}
    frame = spark.createDataFrame(list(given.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    wanted = fill(given)
    assert found.keys() == wanted.keys()
    for name in found:
        assert found[name] == pytest.approx(wanted[name])


def test_repeated_rows_nulls_and_empty_tables(docs):
    rows = [(1, "a b", "en", "s")] * 3 + [(None, "c d", "en", "s"), (None, None, None, None)]
    found = mixing.mix(docs(*rows)).collect()
    assert len(found) == 5
    assert sum(r["taken"] for r in found) == 8
    assert mixing.mix(docs()).collect() == []
    assert mixing.mixed(docs()).collect() == []


def test_mixed_repeats_rows_and_keeps_columns(clashing):
    names = ("size", "target", "copies", "key", "block", "epoch", "source_no", "text_hash")
    rows = [(i, "a b c", "en", "big") for i in range(30)] + [(100 + i, "a b c", "en", "c") for i in range(4)]
    frame = clashing(*rows, names=names)
    out = mixing.mixed(frame)
    assert out.columns == frame.columns
    counts = {r["doc_id"]: r["copies"] for r in mixing.mix(frame).collect()}
    seen = {}
    for r in out.collect():
        assert r["size"] == "size!" and r["copies"] == "copies!"
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert seen == {i: n for i, n in counts.items() if n}
    assert max(counts.values()) == 3


def test_long_text_counts_whole(docs):
    found = sizes(mixing.mix(docs((1, "w " * 300_000, "en", "s"), (2, "x", "en", "t"))))
    assert found[1]["size"] == 300_000
