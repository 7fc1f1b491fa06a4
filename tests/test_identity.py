import hashlib

import pytest

from tillmark.operators.identity import identity_audit, identity_stats, unified_customers

SCHEMA = (
    "record_id string, source string, loyalty_id string, loyalty_verified boolean, email string, "
    "email_verified boolean, phone string, phone_verified boolean, city string, marketing_consent boolean"
)


PERSON = dict(
    source="shop", loyalty_id="", loyalty_verified=False, email="mira@mail.test", email_verified=True, phone="+90 555 010",
    phone_verified=True, city="Izmir", marketing_consent=True,
)
FIELDS = [part.split()[0] for part in SCHEMA.split(", ")]


def person(record_id, **changes):
    """Mira, with some fields changed; a loyalty id counts as verified."""
    row = {**PERSON, "record_id": record_id, "loyalty_verified": bool(changes.get("loyalty_id")), **changes}
    return tuple(row[f] for f in FIELDS)


def resolve(spark, rows):
    audit = identity_audit(spark.createDataFrame(rows, SCHEMA))
    return unified_customers(audit).collect(), audit.collect()


OTHER_MAIL, OTHER_PHONE = {"email": "tuna@mail.test"}, {"phone": "+90 555 020"}
# (what the rows show, changes per row, groups of row numbers that are one customer, whether review is needed)
CASES = [
    ("phone alone", [{}, OTHER_MAIL], [{0}, {1}], False),
    ("mail alone", [{}, OTHER_PHONE], [{0}, {1}], False),
    ("mail in another case and blanks", [{}, {"email": "  MIRA@mail.TEST "}], [{0, 1}], False),
    ("three alike", [{}, {"city": "Van"}, {"source": "app"}], [{0, 1, 2}], False),
    ("one card among the pair", [{}, {"loyalty_id": "K7"}], [{0, 1}], False),
    ("two cards on one pair", [{"loyalty_id": "K7"}, {}, {"loyalty_id": "K8"}], [{0}, {1}, {2}], True),
]


@pytest.mark.parametrize("shown, changes, groups, review", CASES, ids=[c[0] for c in CASES])
def test_who_is_one_customer(spark, shown, changes, groups, review):
    rows = [person(f"N{i}", **c) for i, c in enumerate(changes)]
    for order in (rows, rows[::-1]):
        dim, audit = resolve(spark, order)
        found = {}
        for row in audit:
            found.setdefault(row["customer_id"], set()).add(int(row["record_id"][1:]))
        assert sorted(map(sorted, found.values())) == sorted(map(sorted, groups))
        assert {row["source_records"] for row in dim} == {len(g) for g in groups}
        assert {row["identity_review_required"] for row in audit} == {review}


def test_one_refusal_of_marketing_holds_for_the_customer(spark):
    dim, _ = resolve(spark, [person("N0"), person("N1", marketing_consent=False), person("N2")])
    assert [row["marketing_consent"] for row in dim] == [False]


def test_rule_names_of_an_adopted_card(spark):
    _, audit = resolve(spark, [person("N0", loyalty_id="K7"), person("N1")])
    assert {r["record_id"]: r["match_rule"] for r in audit} == {"N0": "verified_loyalty", "N1": "verified_pair_to_loyalty"}


@pytest.mark.parametrize("email", ["a@example.invalid", "o'hara@example.invalid", 'q"\'x', "back\\slash"])
def test_pair_key_is_the_printed_pair(spark, email):
    _, audit = resolve(spark, [person("R1", email=email, phone="+90 (5) 1-2")])
    expected = "C" + hashlib.sha256(("pair:" + repr((email, "90512"))).encode()).hexdigest()[:16]
    assert audit[0]["customer_id"] == expected


def test_unverified_attributes_are_no_evidence(spark):
    rows = [("R1", "web", "L9", False, "a@x", False, "1", True, None, True), person("R2", email="a@x", phone="1")]
    dim, audit = resolve(spark, rows)
    assert len(dim) == 2 and {r["match_rule"] for r in audit} == {"unmerged_record", "verified_email_and_phone"}


def test_repeated_record_id_is_refused(spark):
    with pytest.raises(ValueError, match="Duplicate record_id"):
        identity_audit(spark.createDataFrame([person("R1"), person("R1")], SCHEMA))


def test_statistics(spark):
    audit = identity_audit(spark.createDataFrame([person("R1"), person("R2"), person("R3", phone="9")], SCHEMA))
    row = identity_stats(unified_customers(audit)).first()
    assert (row["raw_customer_records"], row["unified_customers"], row["collapsed_records"]) == (3, 2, 1)
