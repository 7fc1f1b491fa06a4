"""Spans that only the learned part can find: planted forms beside base forms, and look-alikes that must stay."""

import random

import pytest

from tillmark.llm import personal_data

NAMES = ["anna", "ben", "carla.diaz", "d_ray7", "eva"]
BEFORE, AFTER = "Some words then ", " and the rest"


def digits(draw, n):
    return "".join(draw.choice("0123456789") for _ in range(n))


def luhn_sum(number):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(number)))


def card(draw):
    head = digits(draw, 15)
    return next(head + c for c in "0123456789" if luhn_sum(head + c) % 10 == 0)


def failing_card(draw):
    number = card(draw)
    return number[:-1] + str((int(number[-1]) + draw.randint(1, 9)) % 10)


def in_fours(number, mark):
    return mark.join(number[i : i + 4] for i in range(0, 16, 4))


ADDED = [
    ("phone", lambda d: f"({digits(d, 3)}) {digits(d, 3)}-{digits(d, 4)}"),
    ("phone", lambda d: f"{digits(d, 3)}-555-{digits(d, 4)}"),
    ("email", lambda d: f"{d.choice(NAMES)} at host{digits(d, 1)} dot com"),
    ("email", lambda d: f"{d.choice(NAMES)} (at) example (dot) org"),
    ("card", lambda d: in_fours(card(d), ".")),
    ("ip", lambda d: f"10[.]{d.randint(0, 255)}[.]3[.]{d.randint(0, 255)}"),
]
LEFT_ALONE = [
    lambda d: f"20{d.randint(10, 24)}-0{d.randint(1, 9)}-1{digits(d, 1)} 1{digits(d, 1)}.30",
    lambda d: f"1{digits(d, 1)}.0{d.randint(1, 9)}.2019",
    lambda d: digits(d, d.choice([7, 10, 12])),
    lambda d: "we met at home. We left",
    lambda d: f"{d.randint(1, 9)},{digits(d, 3)},{digits(d, 3)},{digits(d, 3)}",
    lambda d: f"version {digits(d, 1)}.{digits(d, 1)}.{d.randint(300, 900)}.{digits(d, 1)}",
    lambda d: in_fours(failing_card(d), "."),
    lambda d: f"a{digits(d, 10)}f",
]


def base_text(draw):
    return (
        f"You can reach {draw.choice(NAMES)}@mail{digits(draw, 1)}.example.com or +1 ({digits(draw, 3)}) {digits(draw, 3)}-"
        f"{digits(draw, 4)} with {card(draw)} from 10.{draw.randint(0, 255)}.3.{draw.randint(0, 255)} today"
    )


@pytest.fixture(scope="module")
def planted():
    """(doc_id, text) rows and the expected spans of the planted ones."""
    draw, rows, expected = random.Random(3), [], {}
    for i in range(400):
        rows.append((i, base_text(draw)))
    for i in range(400, 1100):
        if i % 2:
            kind, form = ADDED[i % len(ADDED)] if i % 3 else draw.choice(ADDED)
            hit = form(draw)
            expected[i] = f"{kind}:{len(BEFORE)}:{len(BEFORE) + len(hit)}"
        else:
            hit, expected[i] = draw.choice(LEFT_ALONE)(draw), ""
        rows.append((i, BEFORE + hit + AFTER))
    return rows, expected


def spans(spark, rows):
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return {r["doc_id"]: r for r in personal_data.find_personal_data(table).collect()}


def test_other_forms_are_added_and_look_alikes_are_not(spark, planted):
    rows, expected = planted
    found = spans(spark, rows)
    added = {i for i in expected if found[i]["spans"]}
    right = {i for i in expected if expected[i] and found[i]["spans"] == expected[i]}
    wanted = {i for i in expected if expected[i]}
    assert len(right) >= 0.95 * len(wanted), f"recall {len(right)} of {len(wanted)}"
    assert len(right) >= 0.95 * len(added), f"precision {len(right)} of {len(added)}"


def test_without_base_spans_nothing_is_added(spark, planted):
    rows, expected = planted
    found = spans(spark, [r for r in rows if r[0] in expected])
    assert not any(found[i]["spans"] for i in expected)


def test_a_number_cut_by_a_following_address_is_found(spark, planted):
    text = "Call +1 (826) 555-4081 190.137.223.204 now"
    found = spans(spark, [*planted[0], (5000, text)])[5000]
    assert found["n_phone"] == 0 and found["n_ip"] == 1
    assert "phone:5:22" in found["spans"].split(",")


def test_redaction_covers_added_spans(spark, planted):
    rows, expected = planted
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = {r["doc_id"]: r["text"] for r in personal_data.redact(table).collect()}
    for i, span in expected.items():
        if span.startswith("email"):
            assert texts[i] == f"{BEFORE}<EMAIL>{AFTER}"
        elif not span:
            assert texts[i] == dict(rows)[i]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert personal_data.find_personal_data(none).count() == 0
    assert personal_data.redact(none).count() == 0
