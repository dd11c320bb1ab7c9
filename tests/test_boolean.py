import pytest

from colophon.plans import boolean


@pytest.mark.parametrize("query", ["", "  ", "(a", 'a "b', "a or b", "a and b", "not a", "a OR OR b", "a AND OR b", "NOT NOT a", "a ()"])
def test_faulty(query):
    assert boolean.lint(query)


@pytest.mark.parametrize("query", ['"a" AND NOT "b"', '"a" OR NOT "b"', "((a OR b) AND (c OR d))", '"x and y"'])
def test_fine(query):
    assert boolean.lint(query) == [] and boolean.parse(query)


def test_filter_text():
    text = boolean.filter_text("q", [], "2020-01-01")
    assert len(text.split(",")) == 4 - 1 and text.endswith("to_publication_date:2025-12-31")
    full = boolean.filter_text("q", ["T10020", "T00001"], "2020-01-01", "2021-01-01", ["article", "review"])
    assert "primary_topic.id:T10020|T00001" in full and full.endswith("type:article|review")


def test_normalize_is_stable():
    once = boolean.normalize('# note\n( "a b"\n\tOR  c )\n')
    assert once == '("a b" OR c)' == boolean.normalize(once)


def test_search(spark):
    rows = [(1, "Quantum sensing of spins"), (2, "quantum  computing"), (3, "sensors"), (4, None)]
    works = spark.createDataFrame(rows, "id int, text string")
    found = boolean.filter_works(works, 'quantum AND NOT ("computing" OR x)', date_to=None, text=("text",))
    assert [r["id"] for r in found.collect()] == [1]
    for bad in ("a AND", "(a", "OR b", ")"):
        with pytest.raises(ValueError):
            boolean.parse(bad)


def test_bounded():
    assert boolean.bounded_query({"1_core_technology": ["laser"], "3_mechanisms": ["x"]}) == "(((laser)))"
    with pytest.raises(ValueError):
        boolean.bounded_query({"3_mechanisms": ["x"]})
