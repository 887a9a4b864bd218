import pytest

from tuplecohort.functions.exprs import to_spark_sql, truthy_sql


def t(sql):
    return truthy_sql(sql)


@pytest.mark.parametrize("src,expected", [
    ("$0 >= 4 && $1 > 0", t("get(v, 0) >= 4") + " AND " + t("get(v, 1) > 0")),
    ("$0 > 1 || $2 < 3", t("get(v, 0) > 1") + " OR " + t("get(v, 2) < 3")),
    ("!($0 > 1)", "NOT " + t("(get(v, 0) > 1)")),
    ("$0 != 1", "get(v, 0) != 1"),
    ("name == 'a && b || $3'", "name == 'a && b || $3'"),
    ("$0 / ($1 - 2)", "get(v, 0) / nullif((get(v, 1) - 2), 0)"),
    ("`a$1` > 0", "`a$1` > 0"),
    ('"my col" > $10', "`my col` > get(v, 10)"),
])
def test_rewrite(src, expected):
    assert to_spark_sql(src, "v") == expected


def test_rejects_empty():
    with pytest.raises(ValueError):
        to_spark_sql("  ", "v")
