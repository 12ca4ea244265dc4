"""What can be told from the text of a SQL expression, token by token.

Nothing here parses SQL: names are only looked up among the words of a text, so
answers err on the safe side (a word inside a double-quoted string counts as a
name, as it is one under ``doubleQuotedIdentifiers``).
"""

from __future__ import annotations

import re

_TOKEN = re.compile(
    r"""(?P<text>[rR]?'(?:[^'\\]|\\.)*')
      | (?P<quoted>"(?:[^"\\]|\\.)*")
      | (?P<name>`(?:[^`]|``)*`)
      | (?P<comment>--[^\n]*|/\*.*?\*/)
      | (?P<word>[^\W\d]\w*)
      | (?P<space>\s+)
      | (?P<number>\d[\w.]*)
      | (?P<other>.)""",
    re.S | re.X,
)

# Functions that make several rows or columns of one row.
GENERATORS = frozenset(
    "explode explode_outer posexplode posexplode_outer inline inline_outer stack json_tuple variant_explode variant_explode_outer".split()
)

# Functions that raise an error for bad input under ANSI mode, and
# their forms that return NULL instead.
TRY_FORMS = {
    "cast": "try_cast",
    "to_date": "try_to_date",
    "to_timestamp": "try_to_timestamp",
    "to_number": "try_to_number",
    "to_binary": "try_to_binary",
    "to_time": "try_to_time",
    "element_at": "try_element_at",
    "make_timestamp": "try_make_timestamp",
    "make_timestamp_ltz": "try_make_timestamp_ltz",
    "make_timestamp_ntz": "try_make_timestamp_ntz",
    "make_interval": "try_make_interval",
    "mod": "try_mod",
    "parse_json": "try_parse_json",
    "variant_get": "try_variant_get",
    "parse_url": "try_parse_url",
    "url_decode": "try_url_decode",
    "aes_decrypt": "try_aes_decrypt",
    "sum": "try_sum",
    "avg": "try_avg",
}


def _tokens(sql: str) -> list[tuple[str, str]]:
    """(kind, text) of the tokens that mean something."""
    return [(m.lastgroup or "", m.group()) for m in _TOKEN.finditer(sql) if m.lastgroup not in ("space", "comment")]


def names_in(sql: str) -> set[str] | None:
    """Lower-cased words that may name a column in ``sql``; ``None`` if it may
    read any (a star that stands for all columns, a query of its own)."""
    found: set[str] = set()
    before = "("
    for kind, text in _tokens(sql):
        if kind == "word":
            if text.lower() == "select":
                return None
            found.add(text.lower())
        elif kind == "name":
            found.add(text[1:-1].replace("``", "`").lower())
        elif kind == "quoted":
            found.add(text[1:-1].lower())
        elif text == "*" and before in ("(", ",", "."):
            return None
        before = text
    return found


def is_generator(sql: str) -> bool:
    """Whether ``sql`` may call a function that makes several rows of one."""
    return any(kind == "word" and text.lower() in GENERATORS for kind, text in _tokens(sql))


def try_forms(sql: str) -> str:
    """``sql`` with each call in TRY_FORMS replaced by the form that returns
    NULL for bad input. Strings, quoted names and comments stay as they are."""
    out, tokens = [], list(_TOKEN.finditer(sql))
    for i, m in enumerate(tokens):
        text = m.group()
        if m.lastgroup == "word" and text.lower() in TRY_FORMS:
            after = next((t.group() for t in tokens[i + 1 :] if t.lastgroup not in ("space", "comment")), "")
            before = next((t.group() for t in reversed(tokens[:i]) if t.lastgroup not in ("space", "comment")), "")
            if after == "(" and before != ".":
                text = TRY_FORMS[text.lower()]
        out.append(text)
    return "".join(out)
