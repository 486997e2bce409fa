"""Unit strings: segmentation by dynamic programming over tries of prefixes, roots and exponents.

A unit text such as ``"10 µm per pixel"`` is cut into tokens ``[number] [qualifier]* [prefix] root [exponent]`` joined by
``/``, ``per`` or nothing. Every way to cut it gets a score: longer known tokens are better, skipped characters cost, and
the dimension that results adds its log prior beside the field it stands at. So ``mm`` beside a position is a millimetre
and not a square metre, and ``MM`` is no megametre. The best cut's factor, number and frame are what values are
converted by; the name only reports it. A dimension that a field can't have leaves the text without a unit.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from math import log
from typing import NamedTuple

# SI prefixes (power of ten), unit roots (dimension, factor to metres), exponents, qualifiers.
PREFIXES = {
    "p": -12, "n": -9, "u": -6, "µ": -6, "μ": -6, "m": -3, "c": -2, "d": -1, "k": 3,
    "pico": -12, "nano": -9, "micro": -6, "milli": -3, "centi": -2, "deci": -1, "kilo": 3,
}
ROOTS = {
    "m": ("L", 1.0), "metre": ("L", 1.0), "metres": ("L", 1.0), "meter": ("L", 1.0), "meters": ("L", 1.0),
    "micron": ("L", 1e-6), "microns": ("L", 1e-6), "in": ("L", 0.0254), "inch": ("L", 0.0254), "inches": ("L", 0.0254),
    "angstrom": ("L", 1e-10), "angstroms": ("L", 1e-10), "ångström": ("L", 1e-10), "å": ("L", 1e-10), "thou": ("L", 2.54e-5), "mil": ("L", 2.54e-5), "mils": ("L", 2.54e-5),
    "px": ("P", 1.0), "pix": ("P", 1.0), "pixel": ("P", 1.0), "pixels": ("P", 1.0), "dot": ("P", 1.0), "dots": ("P", 1.0),
    "dpi": ("P/L", 1 / 0.0254), "ppi": ("P/L", 1 / 0.0254), "mpp": ("L/P", 1e-6),
    "fraction": ("F", 1.0), "share": ("F", 1.0), "0..1": ("F", 1.0), "relative": ("F", 1.0),
    "thousandths": ("N", 1e-3), "thousandth": ("N", 1e-3), "hundredths": ("N", 1e-2), "tenths": ("N", 1e-1),
}
#: Roots that take a prefix.
METRIC = {"m", "metre", "metres", "meter", "meters"}
EXPONENTS = {"2": 2, "3": 3, "²": 2, "³": 3, "-1": -1, "^-1": -1, "^2": 2, "⁻¹": -1}
QUALIFIERS = {
    "target": "target", "magnification": "", "half": "half", "level-1": "half", "level1": "half", "level 1": "half", "l1": "half",
    "level-0": "level0", "level0": "level0", "level 0": "level0", "l0": "level0", "base": "level0", "full": "level0",
    "resolution": "", "tile": "", "side": "", "corner": "", "local": "", "from": "", "of": "", "at": "", "a": "", "the": "", "level": "",
    "scanner": "", "header": "",
}
DIVIDERS = {"/": -1, "per": -1, "·": 1, "*": 1}
SEPARATORS = " ().,;:_@=[]~"
NUMBER = re.compile(r"\d+(?:[.,]\d+)?(?:e[+-]?\d+)?")
SKIP_COST, TOKEN_GAIN, NUMBER_GAIN, PREFIX_COST, EXPONENT_COST = 3.0, 1.0, 0.2, 0.4, 1.5
#: Log prior of a dimension (powers of metre and pixel) beside a field: lengths and pixels for positions, and so on.
DIMENSION_PRIORS = {
    "position": {(1, 0): log(0.6), (0, 1): log(0.39)},
    "resolution": {(1, -1): log(0.6), (-1, 1): log(0.3), (-1, 0): log(0.08)},
    "ring": {(1, 0): log(0.35), (0, 1): log(0.45), (0, 0): log(0.19)},
    "patch": {(1, 0): log(0.4), (0, 1): log(0.59)},
}
UNLIKELY = log(1e-3)


def _trie(words) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = w
    return root


TRIES = {"prefix": _trie(PREFIXES), "root": _trie(ROOTS), "exponent": _trie(EXPONENTS), "qualifier": _trie(QUALIFIERS), "divider": _trie(DIVIDERS)}


def _walk(kind: str, text: str, i: int):
    node = TRIES[kind]
    while i < len(text) and text[i] in node:
        node, i = node[text[i]], i + 1
        if "" in node:
            yield node[""], i


@dataclass(frozen=True)
class Unit:
    """Factor to metres, pixels and shares; dimension as powers of (metre, pixel); the pixel's frame."""

    factor: float
    dims: tuple[int, int]
    share: bool
    frame: str
    score: float


def _boundary(text: str, i: int) -> bool:
    return i <= 0 or i >= len(text) or not (text[i - 1].isalnum() and text[i].isalnum())


@lru_cache(maxsize=100_000)
def parse(text: str | None, field: str) -> Unit | None:
    """The best decomposition of ``text`` for ``field``; None for null, empty or unit-free text."""
    if text is None or not text.strip():
        return None
    s = " ".join(text.split()).lower()
    # at a position: (sign of the next root, powers, factor, share, frame, any root yet, number that waits for its unit) -> best score
    states: list[dict] = [{} for _ in range(len(s) + 1)]
    states[0][(1, 0, 0, 1.0, False, "", False, None)] = 0.0

    def put(i: int, key: tuple, score: float) -> None:
        if score > states[i].get(key, -1e9):
            states[i][key] = score

    for i in range(len(s)):
        for (sign, length, px, factor, share, frame, some, number), score in list(states[i].items()):
            key = (length, px, factor, share, frame, some, number)
            if s[i] in SEPARATORS:
                put(i + 1, (sign, *key), score)
                if s[i] not in ".,":
                    continue
            put(i + 1, (sign, *key), score - SKIP_COST)
            for w, j in _walk("divider", s, i):
                if w in "/·*" or (_boundary(s, i) and _boundary(s, j)):
                    put(j, (DIVIDERS[w], length, px, factor * (number or 1.0) ** sign, share, frame, some, None), score + TOKEN_GAIN)
            if not _boundary(s, i) and not (s[i - 1].isdigit() and number is not None):
                continue
            if number is None and (m := NUMBER.match(s, i)) and (value := float(m[0].replace(",", "."))) > 0:
                put(m.end(), (sign, length, px, factor, share, frame, some, value), score + NUMBER_GAIN)
            for w, j in _walk("qualifier", s, i):
                if _boundary(s, j):
                    put(j, (sign, length, px, factor, share, frame or QUALIFIERS[w], some, number), score + TOKEN_GAIN * len(w) / 4)
            for power, k, cost in [(0, i, 0.0), *((PREFIXES[w], j, PREFIX_COST) for w, j in _walk("prefix", s, i))]:
                for w, j in _walk("root", s, k):
                    dim, f = ROOTS[w]
                    ends = [(1, j, 0.0), *((EXPONENTS[x], e, EXPONENT_COST) for x, e in _walk("exponent", s, j))]
                    for exponent, e, more in ends:
                        if not _boundary(s, e) or (k > i and w not in METRIC):
                            continue
                        p = sign * exponent
                        dl = {"L": p, "P/L": -p, "L/P": p}.get(dim, 0)
                        dp = {"P": p, "P/L": p, "L/P": -p}.get(dim, 0)
                        size = factor * (f * 10.0**power) ** p * (number or 1.0) ** sign
                        put(e, (1, length + dl, px + dp, size, share or dim == "F", frame, True, None), score + TOKEN_GAIN * (e - i) - cost - more)
    prior = DIMENSION_PRIORS[field]
    best = None
    for (_, length, px, factor, share, frame, some, number), score in states[len(s)].items():
        # a number without a unit after it was none of a unit's
        total = score + prior.get((length, px), UNLIKELY) - (SKIP_COST if number is not None else 0.0)
        if some and (best is None or total > best.score):
            best = Unit(factor, (length, px), share, frame, total)
    return best


def _close(a: float, b: float) -> bool:
    return abs(a / b - 1) < 1e-6


class Scale(NamedTuple):
    """A unit's name and how to bring values to the common one: ``factor`` of ``kind``.

    Kinds: ``um``, ``px`` (level 0), ``target_px``, ``tile`` (the tile's side), ``um_per_px``, ``px_per_um``.
    """

    name: str
    factor: float
    kind: str


# Names of the common lengths, in um.
LENGTHS = {"um": 1.0, "mm": 1e3, "nm": 1e-3, "cm": 1e4, "m": 1e6, "inch": 25400.0}


def _length(um: float) -> str:
    return next((n for n, f in LENGTHS.items() if _close(um, f)), f"{um:g}_um")


def scale(text: str | None, field: str) -> Scale | None:
    """What the best decomposition of ``text`` means for ``field``; None where the field can't have its dimension."""
    u = parse(text, field)
    if u is None or u.dims not in DIMENSION_PRIORS[field]:
        return None
    half = 2.0 if u.frame == "half" else 1.0
    if field == "resolution":
        # of a pixel at half resolution there are two level-0 px
        if u.dims == (1, -1):
            um = u.factor * 1e6 / half
            return Scale(f"{_length(um)}_per_px" if not _length(um).endswith("_um") else f"{um:g}_um_per_px", um, "um_per_px")
        px = u.factor * 1e-6 * half
        return Scale(f"px_per_{_length(1 / px)}", px, "px_per_um")
    if u.share or u.dims == (0, 0):
        return Scale("tile_fraction", u.factor, "tile") if u.share else None
    if u.dims == (1, 0):
        return Scale(_length(u.factor * 1e6), u.factor * 1e6, "um")
    if u.frame == "target":
        return Scale("target_px", u.factor, "target_px")
    size = u.factor * half
    return Scale({1.0: "px", 2.0: "half_px"}.get(size, f"{size:g}_px"), size, "px")


@lru_cache(maxsize=100_000)
def unit_name(text: str | None, field: str) -> str | None:
    found = scale(text, field)
    return found and found.name


_CLAUSE = re.compile(r"[;\n]|\. |, (?!c?y\b)(?=[a-z])")
_POSITION = re.compile(r"\b(?:positions?|centroids?|coordinates?|cx(?:\s*(?:,|and|/)\s*cy)?|x\s*,\s*y|stage units?)\b", re.I)
_SHAPE = re.compile(r"\bshapes?\b", re.I)
_MULTIPLIED = re.compile(r"\b(?P<no>not\s+)?(?:multiplied|scaled)\s+(?:by|with)\s+(?:the\s+)?(?:slide\s+)?(?:mpp|resolution)", re.I)
_SCALE = re.compile(r"(?:=|\bis\b)\s*(\d.*)$", re.I)
_WORDS = re.compile(r"[^\W\d_]+(?:-\d)?|[0-9.]+", re.U)


@lru_cache(maxsize=100_000)
def note_scale(note: str | None) -> Scale | None:
    """The unit of positions that a delivery's note tells; notes about tiles, patches or shapes tell none."""
    if note is None:
        return None
    for clause in _CLAUSE.split(note):
        if not _POSITION.search(clause) or _SHAPE.search(clause):
            continue
        if m := _MULTIPLIED.search(clause):
            return Scale("px", 1.0, "px") if m["no"] else Scale("um", 1.0, "um")
        rest = clause[_POSITION.search(clause).end() :]
        if (m := _SCALE.search(rest)) and (found := scale(m[1], "position")):
            return found
        # the best run of words that make a unit
        words = _WORDS.findall(rest)
        best, found = 0.0, None
        for a in range(len(words)):
            for b in range(a + 1, len(words) + 1):
                piece = " ".join(words[a:b])
                if piece in ("in", "m", "a", "d", "p"):
                    continue
                unit = parse(piece, "position")
                if unit is not None and unit.score > best and (here := scale(piece, "position")):
                    best, found = unit.score, here
        if found:
            return found
    return None


def note_unit(note: str | None) -> str | None:
    found = note_scale(note)
    return found and found.name


_NUMBER = re.compile(r"(?<![\w.,/])(\d+(?:[.,]\d+)?(?:[eE]-?\d+)?)\s*((?:1\s*/\s*)?[^\d;()]+)")


@lru_cache(maxsize=100_000)
def header_resolution(text: str | None) -> tuple[float, Scale] | None:
    """Value and unit of the resolution that a header text tells, decimal commas included."""
    for clause in (text or "").split(";"):
        for m in _NUMBER.finditer(clause):
            if found := scale(m[2].strip(), "resolution"):
                return float(m[1].replace(",", ".")), found
    return None


_RING = re.compile(r"\b(?:polygon|polygons|ring|rings|vertex|vertices|outline|outlines|contour|contours)\b\s*(?:units?\s*[:=]|(?:are\s+)?(?:given|stored|recorded|written)?\s*(?:in|as)\b|[:=])\s*(.+)", re.I)


@lru_cache(maxsize=100_000)
def header_ring(text: str | None) -> Scale | None:
    """The unit of ring coordinates that a header text tells."""
    for clause in (text or "").split(";"):
        if (m := _RING.search(clause)) and (found := scale(m[1].strip(), "ring")):
            return found
    return None
