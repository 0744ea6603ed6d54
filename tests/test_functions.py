import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from docweave.functions import convert, json_fields, naming
from docweave.operators.mapping import conform_to_mapping


def test_coerce_gives_zero_values(frame):
    schema = StructType(
        [
            StructField("a", LongType()),
            StructField("b", ByteType()),
            StructField("c", StringType()),
            StructField("d", IntegerType()),
            StructField("t", TimestampType()),
        ]
    )
    rows = frame([("99999999999999999999", "300", None, "1.5", "2021-01-01 00:00:00")], "a string, b string, c string, d string, t string")
    row = convert.coerce_rows(rows, schema).first()
    assert (row["a"], row["b"], row["c"], row["d"]) == (0, 0, "", 0)
    assert row["t"].year == 2021


def test_projection_keeps_keys_and_rejects_unknown_columns(frame):
    rows = frame([(1, 2, 3)], "a int, b int, c int")
    assert convert.project_columns(rows, include=["C"], keys=["a"]).columns == ["a", "c"]
    assert convert.project_columns(rows, exclude=["a", "b"], keys=["a"]).columns == ["a", "c"]
    with pytest.raises(ValueError):
        convert.project_columns(rows, include=["x"])


@pytest.mark.parametrize("index, label", [(1, "a"), (3, "c"), (0, ""), (4, ""), (-1, ""), (None, None)])
def test_enum_label(one, index, label):
    assert one(convert.enum_label(F.lit(index).cast("int"), ["a", "b", "c"])) == label


@pytest.mark.parametrize("mask, labels", [(0, ""), (1, "a"), (5, "a,c"), (7, "a,b,c"), (8, "")])
def test_set_labels(one, mask, labels):
    assert one(convert.set_labels(F.lit(mask), ["a", "b", "c"])) == labels


def test_bit(one):
    assert one(convert.bit_to_int(F.lit("\x01"))) == 1
    assert one(convert.bit_to_int(F.lit("1"))) == 0


@pytest.mark.parametrize(
    "text, value",
    [
        (0.5, "0.5"), (12.0, "12"), (1e7, "10000000"), (1.25e10, "12500000000"), (123456789.5, "123456789.5"),
        (1e-5, "0.00001"), (-1.5e-7, "-0.00000015"), (-2e20, "-200000000000000000000"), (0.0, "0"), (1e300, "1" + "0" * 300),
    ],
)
def test_double_as_text_has_no_exponent(one, text, value):
    assert one(convert.text_key(F.lit(text), "double")) == value


def test_text_key_of_null_and_nested(one):
    assert one(convert.text_key(F.lit(None).cast("int"), "int")) == ""
    assert one(convert.text_key(F.array(F.lit(1), F.lit(2)), "array<int>")) == "[1,2]"


@pytest.mark.parametrize(
    "text, result",
    [("2021-02-03 04:05:06", "03/02/2021"), ("2021-02-30 00:00:00", None), ("0000-00-00 00:00:00", None), ("soon", None), (None, None)],
)
def test_reformat_datetime(one, text, result):
    value = F.lit(text).cast("string")
    assert one(convert.reformat_datetime(value, "dd/MM/yyyy")) == result
    assert one(convert.reformat_datetime(value, None)) == text


def test_zero_date_is_null(one):
    assert one(convert.reformat_date(F.lit("0001-01-01"), "yyyy")) is None
    assert one(convert.reformat_date(F.lit("2020-02-29"), "MMdd")) == "0229"


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("2021-01-02T00:00:01", 1609545601), ("2021-01-02T00:00:01.500", 1609545601), ("2021-01-02T08:00:01+08:00", 1609545601),
        ("2021-01-02T00:00:01.000Z", 1609545601), ("2021-01-02T00:00", 1609545600), ("2021-01-02 00:00:01", 1609545601), ("2021-01-02", 1609545600), ("2021-01", 1609459200),
        ("2021", 1609459200), ("2021/01/02", 1609545600), ("2021/01", 1609459200), ("1609545600000", 1609545600), ("2021-13-01", None), ("x", None),
    ],
)
def test_multi_format_date(one, text, seconds):
    assert one(F.unix_timestamp(convert.multi_format_date(F.lit(text)))) == seconds


def test_epoch_unit_is_explicit(one):
    assert one(F.unix_timestamp(convert.epoch_to_timestamp(F.lit(5), "s"))) == 5
    assert one(F.unix_timestamp(convert.epoch_to_timestamp(F.lit(5000), "ms"))) == 5
    with pytest.raises(ValueError):
        convert.epoch_to_timestamp(F.lit(5), "us")


@pytest.mark.parametrize(
    "text, valid",
    [
        ('{"k": 1}', True), ("[1]", True), ("3", True), ('"x"', True), ("null", True), ("", False), ('{"k": 1}]', False), ("1,2", False),
        ("{'k': 1}", False), ('{"k"', False), ("1],[2", False), (None, False),
    ],
)
def test_json_is_checked_to_its_end(one, text, valid):
    assert one(json_fields.valid_json(F.lit(text).cast("string"))) is valid


def test_bad_json_keeps_the_text(one):
    good = one(json_fields.json_value(F.lit('{"k": 4}'), "k int"))
    bad = one(json_fields.json_value(F.lit("{oops"), "k int"))
    assert (good["value"]["k"], good["raw"]) == (4, None)
    assert (bad["value"], bad["raw"]) == (None, "{oops")


@pytest.mark.parametrize("ext", ["", "[]", "0", "{broken", '{"a":1} x', None, "{}"])
def test_extension_without_content(one, ext):
    parsed = json_fields.parse_extend(F.lit(ext).cast("string"))
    brands = one(json_fields.brand_lists(parsed))
    assert (brands["show_brands"], brands["hide_brands"]) == ([], [])
    assert one(json_fields.edu_priority(parsed)) == 0


def test_extension_lists(one):
    text = '{"show_brands":" a , b,,","hide_brands":"","show_strategy":"1, x,-2, 3.5","edu_priority":"7"}'
    parsed = json_fields.parse_extend(F.lit(text))
    assert one(json_fields.brand_lists(parsed))["show_brands"] == ["a", "b"]
    assert one(json_fields.strategy_lists(parsed))["show_strategies"] == [1, -2]
    assert one(json_fields.edu_priority(parsed)) == 7


@pytest.mark.parametrize(
    "payment, vip, brands, result",
    [
        ('[{"brand":0,"payment":"vip"},{"brand":12,"payment":"free"}]', "", [0], "vip"),
        ('[{"brand":0,"payment":"a"},{"brand":0,"payment":"b"}]', "x", [0, 0], "b"),
        ('[{"brand":0,"payment":""}]', "x", [], ""),
        ('[{"brand":0}]', "", [], "free"),
        ("", "gold", [], "gold"),
        ("[{", None, [], "free"),
        ("[]", "", [], "free"),
    ],
)
def test_payment(one, payment, vip, brands, result):
    fields = one(json_fields.payment_fields(json_fields.parse_payment(F.lit(payment)), F.lit(vip).cast("string")))
    assert (fields["payment_brands"], fields["vip_type"]) == (brands, result)


def test_split_list_does_not_trim(one):
    assert one(json_fields.split_list(F.lit("a, b,"))) == ["a", " b", ""]
    assert one(json_fields.split_list(F.lit(""))) == []


def test_create_time_below_zero_is_zero(one):
    assert one(convert.effective_create(F.lit(-5).cast("long"))) == 0
    assert one(convert.effective_update(F.lit(5), F.lit(None).cast("int"))) == 5


@pytest.mark.parametrize(
    "name, parts",
    [
        ("app_media20240101000000", ("app_media", "20240101000000", 0, "app_media_")),
        ("app_log202401_dev", ("app_log", "202401", 1, "app_log_")),
        ("app_media", None),
        ("media20240101000000", ("media", "20240101000000", 0, "")),
    ],
)
def test_index_name(one, name, parts):
    parsed = one(naming.parse_index_name(F.lit(name)))
    assert (None if parsed is None else tuple(parsed)) == parts


def test_snapshot_name_round_trip(one):
    name = naming.snapshot_name("app", "media", "20240101000000", dev=True)
    assert one(naming.parse_index_name(F.lit(name)))["stamp"] == "20240101000000"


def test_mapping_names_the_first_bad_field(frame):
    rows = frame([("1", 500, "x"), ("a", 500, "x"), ("2", 5, None)], "id string, size int, other string")
    checked = conform_to_mapping(rows, {"id": "long", "size": "byte"}).collect()
    assert [r["reject_reason"] for r in checked] == ["size", "id", None]
    assert checked[2]["size"] == 5 and checked[0]["other"] == "x"


def test_mapping_of_lists_and_dates(frame):
    rows = frame(
        [(["1", "300"], "2021/01", 1609459200), (["1", "2"], "2021/01", 1609459200), (None, "x", None)], "n array<string>, d string, at long"
    )
    checked = conform_to_mapping(rows, {"n": "byte", "d": "date", "at": "date"}, epoch_unit="s").collect()
    assert [r["reject_reason"] for r in checked] == ["n", None, "d"]
    assert checked[1]["n"] == [1, 2] and checked[1]["d"] == checked[1]["at"]


@pytest.mark.parametrize("text", [" 12", "12 ", "\t7", "2d", "1.5f", "0x1F", "1_000", "", "+", "1e", "."])
def test_number_texts_are_read_strictly(one, text):
    assert one(convert.number_value(F.col("v")), v=text) is None
    assert one(convert.safe_score(F.col("v")), v=text) == 0
    assert one(convert.coerce(F.col("v"), LongType()), v=text) == 0
    assert one(convert.coerce(F.col("v"), DoubleType()), v=text) == 0


@pytest.mark.parametrize(("text", "number"), [("12", 12.0), ("+7", 7.0), ("-.5", -0.5), ("5.", 5.0), ("1e3", 1000.0), ("1e999", 0.0)])
def test_decimal_texts(one, text, number):
    assert one(convert.safe_score(F.col("v")), v=text) == number


@pytest.mark.parametrize(
    ("text", "millis"),
    [
        ("2024-01-01T10", 1704103200000),
        ("2024-01-01T10:00:00.123456", 1704103200123),
        ("2024-01-01T10:00:00.1Z", 1704103200100),
        ("2024-01-01T10:00:00+0800", 1704074400000),
        ("2024-01-01T10:30+08:00", 1704076200000),
        ("2024-01-01T10Z", 1704103200000),
        ("2024", 1704067200000),
        ("999", 999),
        ("-5", -5),
        ("2024-02-30", None),
        ("2024-1-1", None),
        ("2024-01-01T25", None),
        ("2024-01-01 10:00", None),
        ("now", None),
    ],
)
def test_date_shapes(one, text, millis):
    assert one(F.unix_millis(convert.multi_format_date(F.col("v"))), v=text) == millis
