import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from scquarry.operators.packed import Code, cheapest, dialects, parse, split_packed, unwrap

VALUES = ["nCount_min", "pMT_max 12", "user's limit", 'at "raw" stage', "a, b; c", "R&D", "(1.2, dev)", "0,14", "5'_set"]


def test_grammar():
    words = lambda s: [v for v, _ in parse(unwrap(s))]
    assert words('["a", "b"]') == ["a", "b"]
    assert words("a;;b ; ,c") == ["a", "b", "c"]
    assert words("\"say \"\"hi\"\"\";'it''s'") == ['say "hi"', "it's"]
    assert words("5'_set, tip 'x' y") == ["5'_set", "tip 'x' y"]
    assert words('"never closed, b') == ['"never closed', "b"]
    assert words("(a, b)") == ["a", "b"]
    assert words("(a), (b)") == ["(a)", "(b)"]
    assert words(" ; , ") == []
    assert words("a\tb\nc") == ["a", "b", "c"]


def test_costs_decide():
    code = Code(values=1000, separators=600, inside=0, quoted=100, bare=0)
    counts = {"HLX1": 200, "KLD4": 100}
    split, whole = ("/;", ""), (";", "")
    assert cheapest("HLX1;C/EBP long;KLD4", code, counts | {"C/EBP long": 60}) == whole
    assert cheapest("HLX1;C/EBP long;KLD4", code, counts) == split  # a new value
    assert cheapest("HLX1;C/EBP long;KLD4", code, counts | {"C/EBP long": 60, "C": 90, "EBP long": 80}) == split  # its parts are known better
    much = Code(values=1000, separators=600, inside=300, quoted=100, bare=0)
    assert cheapest("HLX1;C/EBP long;KLD4", much, counts | {"C/EBP long": 60, "C": 90, "EBP long": 80}) == whole  # plain values hold delimiters often
    assert len(dialects("a;b,c")) == 4


def test_values_known_from_quotations_stay_whole_where_they_are_plain(spark):
    """The choice differs from splitting at every delimiter where the counts say so, and only there."""
    names = [f"gene{i}" for i in range(30)]
    data = [("m", f'"CD4, naive";{names[i % 30]};{names[i // 30 * 7 % 30]}') for i in range(300)]
    data += [("m", f"{names[i]}, {names[i + 1]} ; {names[i + 2]}") for i in range(25)]
    data += [("m", f'"{names[i]}, {names[i + 1]}" ; {names[i + 2]}') for i in range(3)]  # parts that are values of their own
    odd = [("m", f"CD4, naive;{n}") for n in names] + [("other", "CD4, naive;gene1")]
    quotes = [("q", f"'{y}s, '{y + 10}s") for y in range(60, 80)] + [("q", f"'{y}s") for y in range(60, 90)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data + odd + quotes)], "n int, kind string, f string")
    got = {}
    for n, _, item in sorted(map(tuple, split_packed(df, "kind", "f").select("n", "item_pos", "item").collect())):
        got.setdefault(n, []).append(item)
    first = len(data)
    assert [got[first + i] for i in range(30)] == [["CD4, naive", n] for n in names]
    assert got[first + 30] == ["CD4", "naive", "gene1"]
    assert [got[300 + i] for i in range(25)] == [[names[i], names[i + 1], names[i + 2]] for i in range(25)]
    assert [got[325 + i][0] for i in range(3)] == [f"{names[i]}, {names[i + 1]}" for i in range(3)]
    assert [got[first + 31 + i] for i in range(20)] == [[f"'{y}s", f"'{y + 10}s"] for y in range(60, 80)]


def test_lists_of_rare_values_split_at_any_size(spark):
    """Each list occurs in two raw forms: as a whole it has the count of its values, and a code that grows with the table."""
    for n in (100, 4_000):
        lists = [[f"GSM{i}_L{j}" for j in range(1, 3 + i % 3)] for i in range(n)]
        data = [(2 * i + k, "library_ids", f) for i, v in enumerate(lists) for k, f in enumerate((f" {','.join(v)} ", f"[{','.join(v)}]"))]
        got = split_packed(spark.createDataFrame(data, "n int, kind string, f string"), "kind", "f").select("n", "item_pos", "item")
        assert sorted(map(tuple, got.collect())) == [(2 * i + k, p, x) for i, v in enumerate(lists) for k in (0, 1) for p, x in enumerate(v, 1)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(VALUES), min_size=1, max_size=6), st.sampled_from([";", ", ", " | ", "\t", "/", " & "]), st.sampled_from("\"'"))
def test_round_trip_quoted(values, delimiter, mark):
    field = delimiter.join(mark + v.replace(mark, mark * 2) + mark for v in values)
    assert [v for v, _ in parse(unwrap(field))] == values


def test_split(spark):
    data = [(i, "m", s) for i, s in enumerate([None, "", " ; ", "a;b", "a,b;c", "['x, y', a]", "a", "a;b", "b" * 20000 + ";a"])]
    got = rows(split_packed(spark.createDataFrame(data, "n int, kind string, f string"), "kind", "f").select("n", "item_pos", "item"))
    want = [(3, 1, "a"), (3, 2, "b"), (4, 1, "a"), (4, 2, "b"), (4, 3, "c"), (5, 1, "x, y"), (5, 2, "a"), (6, 1, "a"), (7, 1, "a"), (7, 2, "b"), (8, 1, "b" * 20000), (8, 2, "a")]
    assert got == sorted(want, key=repr)
    assert split_packed(spark.createDataFrame([], "n int, kind string, f string"), "kind", "f").count() == 0
    with pytest.raises(ValueError):
        split_packed(spark.createDataFrame([], "item int, kind string, f string"), "kind", "f")
