import json

import pytest
from pyspark.sql import types as T

from cdclake.contracts import TableContract, contracts_by_table, load_contracts, schemas_match, with_metadata

BASE = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType(), True)])


def changed(*fields):
    return T.StructType(list(fields))


def field(name, kind, nullable=True, metadata=None):
    return T.StructField(name, kind, nullable, metadata)


@pytest.mark.parametrize(
    "inferred, expected",
    [
        (BASE, True),
        (changed(field("id", T.IntegerType(), True), field("name", T.StringType(), False, {"a": 1})), True),
        (changed(field("id", T.IntegerType())), True),
        (changed(field("name", T.StringType())), False),
        (changed(field("id", T.IntegerType()), field("Name", T.StringType())), False),
        (changed(field("id", T.IntegerType()), field("name", T.StringType()), field("x", T.StringType())), False),
        (changed(field("id", T.LongType()), field("name", T.StringType())), False),
        (changed(field("id", T.ShortType()), field("name", T.StringType())), True),
        (changed(field("id", T.ByteType()), field("name", T.StringType())), True),
        (changed(field("id", T.StringType()), field("name", T.StringType())), False),
    ],
)
def test_schema_match(inferred, expected):
    assert schemas_match(inferred, BASE) is expected


def test_int_does_not_stand_for_short():
    assert not schemas_match(changed(field("a", T.IntegerType())), changed(field("a", T.ShortType())))


def test_nested_structs_are_compared():
    inner = changed(field("x", T.IntegerType()), field("y", T.StringType()))
    declared = changed(field("s", inner))
    assert schemas_match(changed(field("s", inner)), declared)
    assert schemas_match(changed(field("s", changed(field("x", T.IntegerType())))), declared)
    assert not schemas_match(changed(field("s", changed(field("x", T.StringType()), field("y", T.StringType())))), declared)
    assert not schemas_match(changed(field("s", changed(field("x", T.IntegerType()), field("z", T.StringType())))), declared)


def test_only_the_class_of_arrays_and_decimals_counts():
    declared = changed(field("a", T.ArrayType(T.IntegerType())), field("d", T.DecimalType(10, 2)))
    assert schemas_match(changed(field("a", T.ArrayType(T.StringType())), field("d", T.DecimalType(5, 0))), declared)


def test_metadata_columns_are_appended():
    added = with_metadata(BASE).fields[2:]
    assert [(f.name, f.nullable) for f in added] == [("Op", False), ("_timestamp", False), ("checkpoint_col", True)]


def test_a_contract_needs_a_key():
    with pytest.raises(ValueError):
        TableContract("s", "t", (), BASE)


def test_contract_files(spark, root):
    contract = {
        "type": "record", "name": "BOOKED_ITEMS_12_3", "namespace": "lake", "service": "shop", "version": "2.1",
        "unknown-property": {"x": [1]},
        "fields": [
            {"name": "ID", "type": "long", "nullable": False, "key": "primary"},
            {"name": "KIND", "type": {"type": "enum", "name": "k", "symbols": ["A", "B"]}, "key": "primary"},
            {"name": "WHEN_AT", "type": {"type": "long", "logicalType": "timestamp-micros"}, "nullable": True},
            {"name": "DAY", "type": {"type": "int", "logicalType": "date"}, "nullable": True},
            {"name": "T1", "type": {"type": "int", "logicalType": "time-millis"}, "nullable": True},
            {"name": "T2", "type": {"type": "long", "logicalType": "time-micros"}, "nullable": True},
            {"name": "RAW", "type": "bytes", "nullable": True},
            {"name": "F", "type": "float", "nullable": True, "key": "foreign"},
            {"name": "N", "type": "null", "nullable": True},
            {"name": "SECRET", "type": "string", "nullable": True,
             "metadata": {"sensitive": True, "validationType": "time"}},
            {"name": "LIST", "type": {"type": "array", "items": "int"}, "nullable": True},
            {"name": "MAYBE", "type": ["null", "double"], "nullable": True},
            {"name": "PRICE", "type": {"type": "bytes", "logicalType": "decimal", "precision": 8, "scale": 2}},
            {"name": "PART", "type": {"type": "record", "name": "p",
                                      "fields": [{"name": "a", "type": ["null", "int"]}, {"name": "b", "type": "string"}]}},
            {"name": "ADDED", "type": "string", "nullable": False, "metadata": {"default": "none"}},
        ],
    }
    other = {"name": "OTHER", "service": "shop", "fields": [{"name": "id", "type": "int", "key": "primary"}]}
    for name, body in (("booked_items", contract), ("other", other)):
        with open(f"{root}/{name}.avsc", "w") as out:
            json.dump(body, out, indent=1)
    rows = load_contracts(spark, f"{root}/*.avsc")
    loaded = contracts_by_table(rows, [("shop", "booked_items_3")])
    assert list(loaded) == [("shop", "booked_items_3")]
    c = loaded["shop", "booked_items_3"]
    assert (c.keys, c.version, c.namespace, c.sensitive) == (("ID", "KIND"), "2.1", "lake", ("SECRET",))
    kinds = {f.name: (f.dataType, f.nullable) for f in c.schema.fields}
    assert kinds == {
        "ID": (T.LongType(), False), "KIND": (T.StringType(), False), "WHEN_AT": (T.TimestampType(), True),
        "DAY": (T.DateType(), True), "T1": (T.IntegerType(), True), "T2": (T.LongType(), True),
        "RAW": (T.BinaryType(), True), "F": (T.FloatType(), True), "N": (T.NullType(), True),
        "SECRET": (T.StringType(), True), "LIST": (T.ArrayType(T.IntegerType(), False), True),
        "MAYBE": (T.DoubleType(), True), "PRICE": (T.DecimalType(8, 2), False),
        "PART": (T.StructType([field("a", T.IntegerType()), field("b", T.StringType(), False)]), False),
        "ADDED": (T.StringType(), False),
    }
    assert c.schema["SECRET"].metadata == {"sensitive": True, "validationType": "time"}
    assert c.schema["ADDED"].metadata == {"default": "none"}
    assert set(contracts_by_table(rows)) == {("shop", "booked_items_3"), ("shop", "other")}


def test_contract_without_key_is_refused(spark, root):
    with open(f"{root}/x.avsc", "w") as out:
        json.dump({"name": "X", "service": "s", "fields": [{"name": "id", "type": "int"}]}, out)
    with pytest.raises(ValueError):
        contracts_by_table(load_contracts(spark, f"{root}/x.avsc"))
