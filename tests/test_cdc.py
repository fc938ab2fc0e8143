import json
import random

import pytest

from smelter.operators import cdc
from smelter.sources.messages import MESSAGE_SCHEMA
from smelter.specs import TableSpec
from tests.helpers import bag, plan, rows

SPEC = TableSpec("t", {"k": "string", "v": "string"}, keys=("k",))


def message(offset, op, ts, before=None, after=None, wrapped=True, partition=0, **extra):
    body = {"before": before, "after": after, "op": op, "ts_ms": ts, **extra}
    return ("t", partition, offset, json.dumps({"payload": body} if wrapped else body))


def changes(spark, messages):
    df = spark.createDataFrame(messages, MESSAGE_SCHEMA)
    return cdc.parse_changes(df, SPEC)


def state(spark, messages, deletes="apply"):
    valid, _ = changes(spark, messages)
    return dict(rows(cdc.latest_by_key(valid, SPEC.keys, deletes=deletes)))


def row(k, v):
    return {"k": k, "v": v}


def test_both_envelope_forms_and_unknown_fields(spark):
    valid, rejected = changes(
        spark,
        [
            message(1, "c", 10, after=row("a", "1")),
            message(2, "u", 11, before=row("a", "1"), after=row("a", "2"), wrapped=False),
            message(3, "r", 12, after={**row("b", "3"), "new": 5}, source={"db": "x"}),
        ],
    )
    assert rows(valid.select("op", "ts_ms", "before.v", "after.k", "after.v").orderBy("ts_ms")) == [
        ("c", 10, None, "a", "1"),
        ("u", 11, "1", "a", "2"),
        ("r", 12, None, "b", "3"),
    ]
    assert rejected.count() == 0


def test_numbers_arrive_as_text(spark):
    valid, _ = changes(spark, [message(1, "c", 10, after={"k": 7, "v": 1506941792123})])
    assert rows(valid.select("after.k", "after.v")) == [("7", "1506941792123")]


def test_malformed_messages_are_kept_aside(spark):
    valid, rejected = changes(
        spark,
        [
            ("t", 0, 1, "{not json"),
            ("t", 0, 2, None),
            ("t", 0, 3, "[]"),
            ("t", 0, 4, '{"payload": {"after": {"k": "a"}}}'),
            message(5, "c", 10, after=row("a", "1")),
        ],
    )
    assert rows(valid.select("kafka_offset")) == [(5,)]
    assert rows(rejected.select("kafka_offset", "raw", "reason").orderBy("kafka_offset"))[:2] == [
        (1, "{not json", "not a change envelope"),
        (2, None, "empty message"),
    ]
    assert rejected.count() == 4


def test_delete_is_applied_or_ignored(spark):
    log = [
        message(1, "c", 10, after=row("a", "1")),
        message(2, "u", 20, after=row("a", "2")),
        message(3, "d", 30, before=row("a", None)),
        message(4, "c", 10, after=row("b", "9")),
    ]
    assert state(spark, log) == {"b": "9"}
    assert state(spark, log, "ignore") == {"a": "2", "b": "9"}


def test_reinsert_after_delete(spark):
    log = [
        message(1, "c", 10, after=row("a", "1")),
        message(2, "d", 20, before=row("a", "1")),
        message(3, "c", 30, after=row("a", "3")),
    ]
    assert state(spark, log) == {"a": "3"}


def test_ties_and_late_messages(spark):
    log = [
        message(1, "u", 20, after=row("a", "early offset")),
        message(2, "u", 20, after=row("a", "late offset")),
        message(3, "u", 5, after=row("a", "late arrival")),
    ]
    assert state(spark, log) == {"a": "late offset"}


def test_keys_meet_after_trimming(spark):
    log = [
        message(1, "c", 10, after=row("a", "1")),
        message(2, "u", 20, after=row("a ", "2")),
        message(3, "d", 30, before=row(" b", None)),
        message(4, "c", 10, after=row("b", "1")),
        message(5, "c", 10, after=row(None, "no key")),
    ]
    assert state(spark, log) == {"a": "2"}


def test_unknown_delete_mode(spark):
    valid, _ = changes(spark, [message(1, "c", 10, after=row("a", "1"))])
    with pytest.raises(ValueError):
        cdc.latest_by_key(valid, SPEC.keys, deletes="maybe")


def folded(log):
    """The log applied one message at a time."""
    current = {}
    for _, partition, offset, text in sorted(
        log, key=lambda m: (json.loads(m[3])["payload"]["ts_ms"], m[1], m[2])
    ):
        body = json.loads(text)["payload"]
        key = (body["after"] or body["before"])["k"]
        if body["op"] == "d":
            current.pop(key, None)
        else:
            current[key] = body["after"]["v"]
    return current


@pytest.mark.parametrize("seed", range(3))
def test_folding_equals_replay_in_order(spark, seed):
    random_ = random.Random(seed)
    log = []
    for offset in range(300):
        # One key takes a third of the log.
        key = "hot" if random_.random() < 0.33 else f"k{random_.randrange(40)}"
        op = random_.choice("ccuuud")
        image = row(key, str(offset))
        log.append(
            message(
                offset,
                op,
                random_.randrange(60),
                before=row(key, None) if op == "d" else None,
                after=None if op == "d" else image,
                partition=hash_of(key),
            )
        )
    expected = folded(log)
    shuffled = random_.sample(log, len(log))
    assert state(spark, shuffled) == expected
    assert state(spark, shuffled + log) == expected  # every message twice


def hash_of(key):
    return sum(map(ord, key)) % 3


def test_bronze_rows_with_rejected_messages_fold_alike(spark):
    log = [
        message(1, "c", 10, after=row("a", "1")),
        ("t", 0, 2, '{"payload": {"after": {"k": "a", "v": "no op"}, "ts_ms": 99}}'),
        ("t", 0, 3, None),
    ]
    bronze = cdc.read_envelopes(spark.createDataFrame(log, MESSAGE_SCHEMA), SPEC)
    for deletes in ("apply", "ignore"):
        assert rows(cdc.latest_by_key(bronze, SPEC.keys, deletes=deletes)) == [("a", "1")]
    assert rows(cdc.current_images(bronze)) == [("a", "1")]


def test_filters_do_not_parse_again(spark):
    valid, _ = changes(spark, [message(1, "c", 10, after=row("a", "1"))])
    text = plan(valid.filter("op <> 'd' AND after.v = '1'"))
    assert text.count("from_json") == 1


def test_log_without_key_counts_a_replay_once(spark):
    valid, _ = changes(
        spark,
        [
            message(1, "r", 10, after=row("a", "1")),
            message(1, "r", 10, after=row("a", "1")),
            message(2, "r", 10, after=row("a", "1")),
            message(3, "d", 20, before=row("a", "1")),
        ],
    )
    assert bag(cdc.current_images(valid)) == {("a", "1"): 1}
    assert bag(cdc.current_images(valid, "ignore")) == {("a", "1"): 2}


def test_updates_of_a_log_without_key(spark):
    valid, _ = changes(
        spark,
        [
            message(1, "c", 10, after=row("a", "1")),
            message(2, "u", 11, before=row("a", "1"), after=row("a", "2")),
            message(3, "d", 12, before=row("never", "seen")),
            message(1, "c", 99, after=row("b", "1")),  # the topic was made anew
        ],
    )
    assert bag(cdc.current_images(valid)) == {("a", "2"): 1, ("b", "1"): 1}


def test_every_wrong_shape_is_rejected_with_its_reason(spark):
    log = [
        message(1, "t", 1),
        message(2, "c", 1),
        message(3, "c", 1, after="oops"),
        message(4, "c", "soon", after=row("a", "1")),
        message(5, "u", 1, after=row(None, "1")),
        message(6, "d", 1),
        message(7, "d", 1, before=row("a", None)),
    ]
    valid, rejected = changes(spark, log)
    assert rows(valid.select("kafka_offset")) == [(7,)]
    assert dict(rows(rejected.select("kafka_offset", "reason"))) == {
        1: "unknown operation",
        2: "no row image",
        3: "no row image",
        4: "no change time",
        5: "no key",
        6: "no row image",
    }
    assert rejected.filter("raw IS NULL").count() == 0


def test_sample_is_the_start_of_the_log(spark):
    log = [message(i, "c", 100 - i, after=row(str(i), "v")) for i in range(10)]
    valid, _ = changes(spark, log)
    assert rows(cdc.sample_changes(valid, 2)) == [("c", 91, "9", "v"), ("c", 92, "8", "v")]


def test_versions_are_cut_before_the_shuffle(spark):
    valid, _ = changes(spark, [message(1, "c", 10, after=row("a", "1"))])
    text = plan(cdc.latest_by_key(valid, SPEC.keys))
    after_shuffle, before_shuffle = text.split("Exchange", 1)
    assert "WindowGroupLimit" in after_shuffle and "Final" in after_shuffle
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
