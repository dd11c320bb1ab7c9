"""Stand-ins for services, by module and function name."""

import json

WORKS = [
    {"id": f"https://x/W{n}", "doi": f"https://doi.org/10.1/{n}", "title": f"Known {n}", "publication_year": 2000 + n, "primary_topic": {"id": f"https://x/T1000{n % 3}", "display_name": f"Topic {n % 3}"},
     "topics": [{"id": f"https://x/T1000{n % 3}", "display_name": f"Topic {n % 3}", "field": {"display_name": "F"}}],
     "authorships": [{"author": {"id": f"https://x/A{n}", "display_name": "Ann", "orcid": f"0000-{n}"}, "raw_affiliation_strings": ["Univ, France"] if n % 2 else []}]}
    for n in range(1, 8)
]


def fetch(filter_text, cursor, per_page):
    if "10.9/fail" in filter_text:
        raise RuntimeError("no budget")
    if filter_text.startswith("doi:"):
        asked = set(filter_text[4:].split("|"))
        found = [w for w in WORKS if w["doi"].removeprefix("https://doi.org/") in asked]
    elif filter_text.startswith("display_name.search:"):
        found = [w for w in WORKS if w["title"] == filter_text.split('"')[1]]
    elif "primary_topic.id:" in filter_text:
        asked = filter_text.split("primary_topic.id:")[1].split(",")[0].split("|")
        found = [w for w in WORKS if w["primary_topic"]["id"][-6:] in asked]
    else:
        found = WORKS
    at = 0 if cursor == "*" else int(cursor)
    return {"results": found[at : at + 2], "meta": {"next_cursor": str(at + 2), "count": len(found)}}


def crossref(doi):
    if doi.endswith("2"):
        return 200, json.dumps({"message": {"author": [{"ORCID": "https://orcid.org/0000-2", "affiliation": [{"name": "Lab, Japan"}]}]}})
    return 404, ""


def complete(prompt, most):
    assert most > 0
    if "first page" in prompt:
        return 'Sure: {"authors": [{"position": 0, "institution": "Tohoku", "country_code": "jp", "confidence": 0.9}, {"institution": "no place"}]}'
    rows = json.loads(prompt[prompt.index("\n") + 1 :])
    said = [{"row_id": str(r["row_id"]), "institution_name": " Sorbonne ", "country_code": "fr", "confidence": 0.95} for r in rows[: len(rows) // 2 + 1]]
    return f"<think>[1]</think>```json\n{json.dumps({'predictions': said})}\n```"


def embed(texts):
    return [[float(len(t)), 1.0, float(t.count("e"))] for t in texts]


PDF = (
    b"%PDF-1.4\n1 0 obj<</Type/Catalog/Pages 2 0 R>>endobj\n2 0 obj<</Type/Pages/Kids[3 0 R 5 0 R]/Count 2>>endobj\n"
    b"3 0 obj<</Type/Page/Parent 2 0 R/Contents 4 0 R>>endobj\n5 0 obj<</Type/Page/Parent 2 0 R/Contents 6 0 R>>endobj\n"
    b"4 0 obj<</Length 9>>stream\nBT /F1 12 Tf 72 700 Td (A \\(first\\) page) Tj 0 -14 Td [(To)-20(hoku)-300(Univ)] TJ T* <4A50> Tj ET\nendstream endobj\n"
    b"6 0 obj<</Length 9>>stream\nBT (second) Tj ET\nendstream endobj\n%%EOF"
)


def get_pdf(url):
    if "missing" in url:
        return 404, "", []
    if "html" in url:
        return 200, "text/html", [b"<html>"]
    if "large" in url:
        return 200, "application/pdf", (b"x" * (1 << 20) for _ in range(40))
    if "down" in url:
        raise OSError("down")
    return 200, "application/octet-stream", [PDF[:50], PDF[50:]]
