import pytest

from tidemark.functions.names import NameCollision, resolve, technical_name, technical_names
from tidemark.operators.ingest import rename_audit, rename_to_technical

from helpers import rows


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("Date", "Date"),
        ("Metals Price Index", "Metals_Price_Index"),
        ("China import Iron Ore Fines 62% FE spot", "China_import_Iron_Ore_Fines_62_FE_spot"),
        ("  a,;{}()\n\t=b  ", "a_b"),
        ("_x_", "x"),
        ("a__b", "a_b"),
        ("preço", "pre_o"),
    ],
)
def test_technical_name(raw, expected):
    assert technical_name(raw) == expected


def test_collision_names_both_originals():
    with pytest.raises(NameCollision, match="a b.*A%b"):
        technical_names(["a b", "A%b"])


def test_name_without_letters_is_refused():
    with pytest.raises(ValueError, match="%%"):
        technical_names(["a", "%%"])


def test_resolve_accepts_raw_and_technical_names_and_lists_all_missing():
    assert resolve(["a b", "c"], ["a_b", "c"]) == {"a_b": "a b", "c": "c"}
    assert resolve(["a_b"], ["a b"]) == {"a b": "a_b"}
    assert resolve(["Date", "date_2"], ["date"]) == {"date": "Date"}
    assert resolve(["A b", "a b"], ["a b"]) == {"a b": "a b"}
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        resolve(["a"], ["x", "a", "y"])
    with pytest.raises(NameCollision):
        resolve(["a b", "a%b"], ["a_b"])


def test_rename_keeps_values_and_records_the_original(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b c` int, d int")
    renamed = rename_to_technical(df)
    assert renamed.columns == ["a_b_c", "d"]
    assert renamed.schema["a_b_c"].metadata == {"comment": "a.b c"}
    assert rows(renamed) == [(1, 2)]
    assert rows(rename_audit(df)) == [(0, "a.b c", "a_b_c")]


def test_rename_audit_of_clean_names_is_empty(spark):
    assert rename_audit(spark.createDataFrame([(1,)], "a int")).count() == 0
