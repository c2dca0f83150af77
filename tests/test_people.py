"""Nested records and their fallback."""

import json

import pytest

from parceltrail.plans import people
from parceltrail.sources.people import (
    FALLBACK_PEOPLE,
    documents_or_fallback,
    fallback_document,
    parse_documents,
)

DOC = {"number": 2, "people": [{"craft": "ISS", "name": "A"}, {"craft": "T", "name": "B"}]}


def test_messages(spark):
    df = spark.createDataFrame([(json.dumps(DOC),)], "doc string")
    found = people.messages(parse_documents(df, "doc")).collect()
    assert sorted(r.message for r in found) == [
        "A is currently in space flying on the ISS! Hello! :)",
        "B is currently in space flying on the T! Hello! :)",
    ]


def test_number_of_records(spark):
    df = spark.createDataFrame([(json.dumps(DOC),), (json.dumps({**DOC, "number": 3}),)], "doc string")
    found = people.count_matches(parse_documents(df, "doc")).collect()
    assert [r.count_ok for r in found] == [True, False]


@pytest.mark.parametrize("indent", [None, 2])
def test_documents_from_files(spark, tmp_path, indent):
    (tmp_path / "people.json").write_text(json.dumps(DOC, indent=indent))
    found = people.person_rows(documents_or_fallback(spark, str(tmp_path), indent is not None))
    assert sorted((r.number, r.craft, r.name) for r in found.collect()) == [
        (2, "ISS", "A"),
        (2, "T", "B"),
    ]


@pytest.mark.parametrize("text", [None, "", "not json", '{"people": []}', '{"number": 1}'])
def test_fallback(spark, tmp_path, text):
    if text is not None:
        (tmp_path / "people.json").write_text(text)
    path = str(tmp_path if text is not None else tmp_path / "absent")
    found = people.person_rows(documents_or_fallback(spark, path)).collect()
    assert [(r.craft, r.name) for r in found] == FALLBACK_PEOPLE
    assert {r.number for r in found} == {12}


def test_fallback_document_is_consistent(spark):
    assert people.count_matches(fallback_document(spark)).first().count_ok


def test_a_bad_document_among_good_ones_fails(spark, tmp_path):
    good = "\n".join(json.dumps(DOC) for _ in range(1000))
    for bad in ("not json", '{"number": 1}'):
        (tmp_path / "people.json").write_text(f"{good}\n{bad}\n")
        documents = documents_or_fallback(spark, str(tmp_path))
        with pytest.raises(Exception, match="incomplete document"):
            people.person_rows(documents).collect()
    (tmp_path / "people.json").write_text(good)
    assert people.person_rows(documents_or_fallback(spark, str(tmp_path))).count() == 2000


@pytest.mark.parametrize("text", ["not json", '{"number": 1}', None])
def test_text_that_is_no_document_fails(spark, text):
    df = spark.createDataFrame([(json.dumps(DOC),), (text,)], "doc string")
    with pytest.raises(Exception):
        people.person_rows(parse_documents(df, "doc")).collect()
