"""Settings of a collection: a file, its defaults, and templates for a new one."""

from __future__ import annotations

from copy import deepcopy
from pathlib import Path

# What holds where a file says nothing.
DEFAULTS = {
    "api": {"key": "", "groq_key": "", "semanticscholar_key": "", "email": "", "base_url": ""},
    "filters": {"date_from": "2003-01-01", "date_to": "2024-12-31", "doc_types": ["article", "review", "proceedings-article"]},
    "keywords_file": "config/keywords.txt",
    "topics_file": "config/topics.txt",
    "anchor_file": "config/anchor.txt",
    "collection": {"batch_size_topics": 10, "per_page": 200, "concurrent_requests": 10, "max_retries": 5, "retry_delay": 2},
    "llm": {"provider": "ollama", "model": "", "base_url": "http://localhost:11434"},
    "output": {"jsonl_dir": "data/raw/", "db_dir": "data/db/"},
}
TEMPLATES = {
    "keywords.txt": '# one Boolean query; lines with # are comments\n("first phrase" OR word)\nAND NOT other\n',
    "topics.txt": "# topic ids, one a line: T and five digits\n",
    "anchor.txt": "# DOIs or titles that the search must find, one a line\n",
}


def _plain(text: str) -> dict:
    """A file of ``name: value`` lines, sections by indentation, lists as ``- item`` or ``[a, b]``."""

    def value(x: str):
        x = x.strip()
        if x.startswith("[") and x.endswith("]"):
            return [value(v) for v in x[1:-1].split(",") if v.strip()]
        if len(x) > 1 and x[0] == x[-1] and x[0] in "'\"":
            return x[1:-1]
        return int(x) if x.lstrip("-").isdigit() else x

    out: dict = {}
    section, name = out, None
    for line in text.splitlines():
        bare = line.split(" #")[0].rstrip()
        if not bare.strip() or bare.lstrip().startswith("#"):
            continue
        if bare.lstrip().startswith("- "):
            held = section.get(name)
            section[name] = [*(held if isinstance(held, list) else []), value(bare.lstrip()[2:])]
            continue
        key, _, rest = bare.strip().partition(":")
        if not bare.startswith(" "):
            section = out
            if not rest.strip():
                section = out[key] = {}
                continue
        name = key
        section[key] = value(rest) if rest.strip() else None
    return out


def load(path: str) -> dict:
    """A file's settings over the defaults; ``FileNotFoundError`` without a file."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        said = _plain(text)
    else:
        said = yaml.safe_load(text) or {}
    out = deepcopy(DEFAULTS)
    for name, value in said.items():
        out[name] = out.get(name, {}) | (value or {}) if isinstance(out.get(name), dict) else value
    return out


def api_keys(api: dict) -> list[str]:
    """``keys``; else ``key`` and then ``key1``, ``key2`` and so on, each once."""
    if api.get("keys"):
        return list(api["keys"])
    numbered = sorted((int(k[3:]), v) for k, v in api.items() if k.startswith("key") and k[3:].isdigit())
    return list(dict.fromkeys(k for k in [api.get("key"), *(v for _, v in numbered)] if k))


def listed(path: str) -> list[str]:
    """Entries of a list file, without comments and blank lines; none without a file."""
    from colophon.sources.readers import setting_lines

    return setting_lines(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else []


def _shown(settings: dict, indent: str = "") -> str:
    out = ""
    for name, value in settings.items():
        if isinstance(value, dict):
            out += f"{indent}{name}:\n{_shown(value, indent + '  ')}"
        else:
            text = f"[{', '.join(map(str, value))}]" if isinstance(value, list) else repr(value) if isinstance(value, str) else str(value)
            out += f"{indent}{name}: {text}\n"
    return out


def write_templates(folder: str, force: bool = False) -> list[str]:
    """Names of the files written; what is there stays unless ``force``."""
    place = Path(folder)
    place.mkdir(parents=True, exist_ok=True)
    made = []
    for name, text in {"collection.yml": _shown(DEFAULTS), **TEMPLATES}.items():
        if force or not (place / name).exists():
            (place / name).write_text(text, encoding="utf-8")
            made.append(name)
    return made
