"""Splitting texts by a tokenizer's pattern exactly as its library does.

The installed regex module and the tokenizer libraries carry different Unicode
tables: some code points are letters or numbers for one and not for the other.
:func:`word_splitter` asks the library which code points its classes hold, and
texts with a code point on which the two differ are split by a pattern that
spells the library's classes out.
"""

from __future__ import annotations

from functools import lru_cache

CLASSES = (r"\p{L}", r"\p{N}")


def _ranges(points: list[int]) -> str:
    """The points as the inside of a regex set."""
    out, start = [], None
    for at, c in enumerate(points):
        if start is None:
            start = c
        if at + 1 == len(points) or points[at + 1] != c + 1:
            out.append(f"\\U{start:08x}-\\U{c:08x}")
            start = None
    return "".join(out)


@lru_cache(1)
def library_classes() -> tuple[dict[str, str], str]:
    """The library's letter and number classes as regex sets, and the set of
    code points that the regex module classes otherwise (may be empty)."""
    import regex
    import tiktoken

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    ranks = {bytes([i]): i for i in range(256)}
    sets, odd = {}, set()
    for name in CLASSES:
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=ranks, special_tokens={})
        found = probe.decode(probe.encode_ordinary(every))
        sets[name] = _ranges([ord(c) for c in found])
        odd |= set(found) ^ set(regex.findall(name, every))
    points = sorted(map(ord, odd))
    if points and points[0] < 0x100:
        raise ValueError("the regex module and the tokenizer library class Latin letters differently")
    return sets, _ranges(points)


def splitter_spec(pattern: str) -> tuple[str, str, str]:
    """(pattern, odd, exact): texts that match ``odd`` are split by ``exact``."""
    sets, odd = library_classes()
    exact, inside, at = "", False, 0
    while at < len(pattern):
        name = next((n for n in CLASSES if pattern.startswith(n, at)), None)
        if name:
            exact += sets[name] if inside else f"[{sets[name]}]"
            at += len(name)
            continue
        if pattern[at] == "\\":
            exact += pattern[at : at + 2]
            at += 2
            continue
        inside = pattern[at] == "[" or inside and pattern[at] != "]"
        exact += pattern[at]
        at += 1
    return pattern, f"[{odd}]" if odd else "", exact


class WordSplitter:
    """Calls give the list of a text's matches."""

    def __init__(self, spec: tuple[str, str, str]):
        import regex

        pattern, odd, exact = spec
        self.plain = regex.compile(pattern).findall
        self.odd = regex.compile(odd).search if odd else None
        self.exact = regex.compile(exact).findall

    def __call__(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")  # much faster than a search; no odd ones among these
        except UnicodeEncodeError:
            if self.odd is not None and self.odd(text):
                return self.exact(text)
        return self.plain(text)
