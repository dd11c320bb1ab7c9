import pytest
from pyspark.sql import functions as F

from colophon.functions import country, normalize


def values(spark, f, rows, kind="string"):
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], f"k int, x {kind}")
    return [r[1] for r in sorted(frame.select("k", f(F.col("x"))).collect(), key=lambda r: r[0])]


def test_dois(spark):
    given = ["10.1038/Foo", "  10.1038/Foo ", "https://doi.org/10.1038/Foo", "http://doi.org/10.1/x", "DOI:10.1/X", "", None]
    assert values(spark, normalize.doi_key, given) == ["10.1038/foo", "10.1038/foo", "10.1038/foo", "10.1/x", "10.1/x", None, None]
    assert values(spark, normalize.doi_bare, given) == ["10.1038/Foo", "10.1038/Foo", "10.1038/Foo", "10.1/x", "10.1/X", "", ""]
    checked = ["10.1038/NATURE23474", "https://dx.doi.org/10.1038/a", "doi: 10.1038/b ", "doi:bad", None]
    assert values(spark, normalize.doi_checked, checked) == ["10.1038/nature23474", "10.1038/a", "10.1038/b", None, None]


def test_titles(spark):
    given = ["Quantum Computing: A Survey", "  multiple   spaces  ", "Müller über Bose-Einstein", "Title (with) [brackets] & punctuation!", "", None, "  "]
    want = ["quantum computing a survey", "multiple spaces", "muller uber bose einstein", "title with brackets punctuation", None, None, None]
    assert values(spark, normalize.title_key, given) == want
    loose = values(spark, normalize.title_loose, ["A: B", "a   b", "A_B", None])
    assert loose == ["a b", "a b", "a b", ""]


def test_abstracts(spark):
    kind = "map<string,array<int>>"
    given = [{"Hello": [0], "world": [1]}, {"the": [0, 3], "cat": [1], "sat": [2], "mat": [4]}, {"B": [1], "A": [0], "C": [2]}, None, {}]
    texts = ["Hello world", "the cat sat the mat", "A B C", "", ""]
    assert values(spark, normalize.abstract_text, given, kind) == texts
    assert values(spark, normalize.abstract_last, given, kind) == [t or None for t in texts]


@pytest.mark.parametrize(
    "text, status, code",
    [
        ("Department of Physics, University of Oxford, Oxford, United Kingdom", "unambiguous", "GB"),
        ("Joint Center between USA and China for Quantum Systems", "ambiguous", None),
        ("School of Geodesy and Geomatics, Wuhan Univ", "none", None),
        ("Kowloon, Hong Kong", "unambiguous", "CN"),
        ("Hong Kong, China", "ambiguous", None),
        (None, "none", None),
    ],
)
def test_countries(spark, text, status, code):
    row = spark.createDataFrame([(text,)], "t string").select(country.infer_country(F.col("t")).alias("c")).first()["c"]
    assert (row["status"], row["country_code"]) == (status, code)


def test_codes_files_and_ids(spark):
    assert values(spark, normalize.country_code, ["HK", " cn ", "", None]) == ["CN", "CN", None, None]
    files = ["China.xlsx", "data/UK.xlsx", "Hong Kong.xlsx", "Atlantis.xlsx", country.AGGREGATE_FILES[0]]
    assert values(spark, country.country_of_file, files) == ["CN", "GB", "CN", None, None]
    assert values(spark, normalize.arxiv_id, ["10.48550/arXiv.1706.07415", "10.48550/ARXIV.cond-mat/0408050", "10.1/x", None]) == ["1706.07415", "cond-mat/0408050", None, None]
    assert values(spark, normalize.last_segment, ["https://x/W1", "W2", "", None]) == ["W1", "W2", None, None]
    assert values(spark, normalize.top_flag, ["1", "0", "", None, "yes", "2"]) == [True, False, False, False, True, False]
    metrics = values(spark, normalize.text_metrics, ["", "abc", "a\nb\nc"])
    assert [tuple(m) for m in metrics] == [(0, 0, True), (3, 1, False), (5, 3, False)]


def test_folding_holds_few_texts_at_once(monkeypatch):
    """A batch of long texts is never whole in Python strings; characters alone give what whole texts give."""
    import unicodedata

    import pyarrow as pa

    monkeypatch.setattr(normalize, "TEXT_BYTES", 1000)
    texts = ["Ἀρχή ﬁ " * 60, None, "", "a\u0323\u0307\u0301 한글 ½"] * 50
    parts = list(normalize._in_parts(pa.array(texts), normalize._decomposed))
    assert max(len(p) for p in parts) < 20 and max(sum(len(t or "") for t in p.to_pylist()) for p in parts) < 1000
    whole = [None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    assert [t for p in parts for t in p.to_pylist()] == whole
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    assert normalize._decomposed(every) == "".join(c for c in unicodedata.normalize("NFKD", every) if not unicodedata.combining(c))
