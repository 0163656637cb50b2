import random

import pytest

from tests.conftest import rows
from weft.operators import parsing

LINES = "line_id long, file_name string, line_text string"


def strict(text):
    """Fields of a text by the grammar, one character at a time, or None."""
    fields, i = [], 0
    while True:
        out = ""
        if text[i : i + 1] == '"':
            i += 1
            while True:
                if i >= len(text):
                    return None
                if text[i] == '"':
                    if text[i + 1 : i + 2] == '"':
                        out += '"'
                        i += 2
                        continue
                    i += 1
                    break
                out += text[i]
                i += 1
            if i < len(text) and text[i] != "\t":
                return None
        else:
            while i < len(text) and text[i] != "\t":
                out += text[i]
                i += 1
        fields.append(out)
        if i >= len(text):
            return fields
        i += 1


def test_cost_and_fields_equal_a_plain_reader():
    random.seed(2)
    for _ in range(4000):
        text = "".join(random.choices('ab"\t', k=random.randint(0, 9)))
        quotes, there, edits = parsing.least_edits(parsing.shape(text), 4)
        fields = strict(text)
        assert (quotes == 0) == (fields is not None)
        if fields is not None:
            assert there == len(fields) and parsing.split_fields(text) == fields
        assert (edits == "") == (fields is not None and len(fields) == 4)


@pytest.mark.parametrize(("text", "edits"), [("a\tb\tc", "+tab"), ("a\tb\tc\td\te", "-tab"), ('"a\tb\tc\td', "-quote"), ("", "+tab +tab +tab")])
def test_cheapest_repair(text, edits):
    assert parsing.least_edits(parsing.shape(text), 4)[2] == edits


def test_reasons_in_order(spark):
    good = "S1-000000001\tA\t1 B Street\tUS"
    data = [
        (1, "train_source1.tsv", good), (2, "train_source1.tsv", good.replace("S1", "S2")), (3, "train_source1.tsv", '"x' + good), (4, "train_source1.tsv", "a\tb"), (5, "train_source1.tsv", None),
        (6, "train_source2.tsv", "S2-000000001\tA\t----\tUS"), (7, "train_source2.tsv", "S2-000000001\tA\t\tUS"), (8, "train_source2.tsv", 'S2-000000001\tA\t"1\tB"\tUS'),
        (9, "train_source2.tsv", "S2-000000001\tA\t1 B\x7f\tUS"), (10, "other.tsv", good), (11, None, good), (12, "train_source1.tsv", '"x\t-'), (13, "train_source1.tsv", good + "\n"),
    ]
    got = {r.line_id: r.reason for r in parsing.read_deliveries(spark.createDataFrame(data, LINES)).collect()}
    assert got == {1: None, 2: "entity_id", 3: "quoting", 4: "column_count", 5: "column_count", 6: "business_address", 7: None, 8: None, 9: "business_address", 10: "entity_id", 11: "entity_id", 12: "quoting", 13: None}


def test_loaded_values(spark):
    schema = "entity_id string, business_name string, business_address string, country string, reason string, a string"
    first = spark.createDataFrame([("S1-000000001", "", "", "", "", ""), ("S1-00000000１", "", "", "", "", ""), (None, "", "", "", "", ""), ("S1-000000001\n", "", "", "", "", "")], schema)
    assert rows(parsing.check_ids(first, "S1-")) == [("", "entity_id"), ("S1-000000001\n", "entity_id"), ("S1-00000000１", "entity_id")]
    values = {"a": '"1 B"', "b": '"1 B', "c": "1 B\tC", "d": '"1\tB"', "e": None, "f": "", "g": "  ", "h": 'say "hi"', "i": '"a ""b"" c"', "j": '""', "k": '"12"', "l": "एक", "m": '"a\nb"', "n": '"a"\tb'}
    second = spark.createDataFrame([(k, "", v, "", "", "") for k, v in values.items()], schema)
    assert rows(parsing.check_addresses(second)) == [("b", "quoting"), ("c", "business_address"), ("g", "business_address"), ("k", "business_address"), ("m", "business_address"), ("n", "business_address")]
    assert {r.entity_id for r in parsing.valid_source2(second).collect()} == set(values) - set("bcgkmn")
    assert parsing.failures(spark.createDataFrame([], LINES), first.limit(0), second.limit(0)).count() == 0


def test_long_fields_are_read_whole(spark):
    text = "S1-000000001\t" + 'x "y" ' * 20000 + "\t1 B\tUS"
    row = parsing.read_deliveries(spark.createDataFrame([(1, "train_source1.tsv", text)], LINES)).first()
    assert row.reason is None and len(row.business_name) == 120000
