"""Top lists and their changes."""

import json
import random

from namepulse.operators import live


def table(spark, rows):
    return spark.createDataFrame(rows, "name string, count bigint")


def greedy(updates, k):
    """The bounded list updated in place: a newcomer must beat the minimum."""
    kept = {}
    for name, count in updates:
        if name in kept or len(kept) < k:
            kept[name] = count
        else:
            least = min(kept.items(), key=lambda item: (item[1], item[0]))
            if count > least[1]:
                del kept[least[0]]
                kept[name] = count
    return kept


def test_exact_list_equals_greedy_while_counts_rise(spark):
    rng, counts, updates = random.Random(1), {}, []
    for _ in range(600):
        name = f"n{min(int(rng.expovariate(0.08)), 60)}"
        counts[name] = counts.get(name, 0) + 1
        updates.append((name, counts[name]))
    rows = spark.createDataFrame(
        [(n, c, i) for i, (n, c) in enumerate(updates)], "name string, count bigint, seq bigint"
    )
    top = live.top_names(live.latest_per_name(rows), 10).collect()
    assert sorted(r["count"] for r in top) == sorted(greedy(updates, 10).values())


def test_latest_wins_though_lower(spark):
    rows = spark.createDataFrame(
        [("a", 9, 1), ("a", 2, 3), ("a", 5, 2), ("b", 4, 1)], "name string, count bigint, seq bigint"
    )
    assert sorted(map(tuple, live.latest_per_name(rows).collect())) == [("a", 2), ("b", 4)]


def test_minimum_and_size(spark):
    rows = table(spark, [("c", 2), ("b", 2), ("a", 7)])
    assert tuple(live.topk_minimum(rows).first()) == ("b", 2, 3)


def test_delta_reports_gone_names_as_zero(spark):
    before, after = table(spark, [("a", 1), ("b", 2), ("c", 3)]), table(spark, [("b", 2), ("c", 4), ("d", 1)])
    assert sorted(map(tuple, live.topk_delta(before, after).collect())) == [("a", 0), ("c", 4), ("d", 1)]


def test_message_escapes_names_and_is_absent_without_change(spark):
    rows = table(spark, [('say "hi"\\', 2), ("a", 0)])
    message = live.delta_json(rows).first().message
    assert json.loads(message) == [{"name": "a", "count": 0}, {"name": 'say "hi"\\', "count": 2}]
    assert live.delta_json(live.topk_delta(rows, rows)).count() == 0


def test_list_leaves_out_gone_names(spark):
    assert [r.name for r in live.top_names(table(spark, [("a", 0), ("b", 1)])).collect()] == ["b"]
