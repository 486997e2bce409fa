"""Words of LaTeX articles: what a reader sees, without markup, as plain word sequences."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

DEFINITION = re.compile(r"\\(?:(?:re)?newcommand|providecommand|DeclareRobustCommand|DeclareMathOperator)\*?\s*(?:\{\s*\\([A-Za-z@]+)\s*\}|\\([A-Za-z@]+))\s*(?:\[(\d)\])?(?:\[[^\]]*\])?\s*(?=\{)|\\[gex]?def\s*\\([A-Za-z@]+)\s*((?:#\d)*)\s*(?=\{)")
BRACE = re.compile(r"\\.|[{}]", re.S)
CALL = re.compile(r"\\([A-Za-z@]+)")
OPENING = re.compile(r"\s*\{")
# Commands whose arguments name something and are no words.
KEYED = re.compile(r"\\(?:[A-Za-z]*cite[A-Za-z]*|(?:page|eq|auto|name|sub|full|[vVcCfFsS])?ref|[cC]refrange|label|bibitem)(?![A-Za-z])\*?(?:\s*\[[^\]]*\])*(?:\s*\{[^{}]*\})*")
# Commands that only set a font, so a word may go on across their braces.
FONT = re.compile(r"\\(?:emph|text(?:it|bf|tt|sc|rm|sf|sl|up|md|normal)?|math(?:rm|bf|it|sf|tt|cal|bb)|underline|uline|mbox|hbox)\s*\{([^{}]*)\}")
COMMAND = re.compile(r"\\(?:[A-Za-z@]+\*?|[^A-Za-z\s])|\\$")
ACCENT = re.compile(r"\\(['\"`^~=.])\s*(?:\{\\?([A-Za-z])\}|\\?([A-Za-z]))|\\([cvuHrk])\s*\{([A-Za-z])\}")
COMBINING = {"'": "\u0301", '"': "\u0308", "`": "\u0300", "^": "\u0302", "~": "\u0303", "=": "\u0304", ".": "\u0307", "c": "\u0327", "v": "\u030c", "u": "\u0306", "H": "\u030b", "r": "\u030a", "k": "\u0328"}
INVISIBLE = re.compile("[\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\U000e0000-\U000e0fff]")
SOFT = re.compile("\u00ad(?:[ \t]*\r?\n[ \t]*%?[ \t]*)?")
#: A hyphen within a word, at a line's end too (the next line may be commented).
HYPHEN = re.compile("(?:-(?<=[^\\W_]-)|\\\\-(?<=[^\\W_]\\\\-)|" + "|".join(f"{h}(?<=[^\\W_]{h})" for h in "\u2010\u2011\ufe63\uff0d") + ")(?:[ \t]*\r?\n[ \t]*(?:%+[ \t]*)?)?(?=[^\\W_])")
WORD, ASCII_WORD = re.compile(r"[^\W_]+"), re.compile(r"[a-z0-9]+")
PIECE_OF_WORD = re.compile(r"\{(?<![\\A-Za-z\}\]]\{)([^\W_]{1,3})\}(?=[^\W_])")


def braces(text: str) -> dict[int, int]:
    """The place of each opening brace and that of the one that closes it, however deep; an open end has none."""
    pairs, waiting = {}, []
    for m in BRACE.finditer(text):
        if m[0] == "{":
            waiting.append(m.start())
        elif m[0] == "}" and waiting:
            pairs[waiting.pop()] = m.start()
    return pairs


def closer(text: str) -> Callable[[int], int | None]:
    """Gives the place of the brace that closes the one at a place; the whole text is paired up once one stays open."""
    pairs: dict[int, int] | None = None

    def close(at: int) -> int | None:
        nonlocal pairs
        if pairs is None:
            deep = 0
            for m in BRACE.finditer(text, at):
                deep += {"{": 1, "}": -1}.get(m[0], 0)
                if not deep:
                    return m.start()
            pairs = braces(text)
        return pairs.get(at)

    return close


def macros(text: str) -> dict[str, tuple[int, str]]:
    """Author macros: name to number of arguments and replacement; a later definition replaces an earlier one."""
    found: dict[str, tuple[int, str]] = {}
    if "\\newcommand" in text or "def" in text or "\\renewcommand" in text or "\\DeclareM" in text or "\\providecommand" in text or "\\DeclareR" in text:
        close, at = closer(text), 0
        for m in DEFINITION.finditer(text):
            # a definition within another one's replacement isn't made yet
            if m.start() < at:
                continue
            end = close(m.end())
            if end is not None:
                found[m[1] or m[2] or m[4]] = (m[5].count("#") if m[4] else int(m[3] or 0), text[m.end() + 1 : end])
                at = end
    return found


#: Characters that a text may grow to when its macros are put in; a macro that doubles itself over and over stays as it is.
MOST_EXPANDED = 50_000_000


#: Calls within arguments of calls that are put in; what lies deeper stays as it is.
MOST_NESTED = 100


def expand(text: str, defined: dict[str, tuple[int, str]]) -> str:
    """``text`` with author macros replaced, also inside each other and in their arguments.

    Every replacement is worked out once, those that it uses first; a macro that uses itself stays as it is. Then one
    pass over the text puts them in.
    """
    most = max(n for n, _ in defined.values())
    whole: dict[str, str | None] = {}
    room = MOST_EXPANDED

    def body(name: str, deep: int) -> str | None:
        if name not in whole:
            # while its own replacement is worked out, a name has none
            whole[name] = None
            whole[name] = put_in(defined[name][1], deep)
        return whole[name]

    def put_in(part: str, deep: int) -> str:
        nonlocal room
        if deep > MOST_NESTED:
            return part
        out, at, close = [], 0, closer(part)
        for m in CALL.finditer(part):
            if m.start() < at or m[1] not in defined:
                continue
            new = body(m[1], deep + 1)
            if new is None or len(new) > room:
                continue
            end, given = m.end(), []
            while len(given) < most and (g := OPENING.match(part, end)):
                if (last := close(g.end() - 1)) is None:
                    break
                given.append(put_in(part[g.end() : last], deep + 1))
                end = last + 1
            if part.startswith("{}", end):
                end += 2
            n = defined[m[1]][0]
            for i in range(n):
                new = new.replace(f"#{i + 1}", given[i] if i < len(given) else " ")
            new += "".join(" " + g + " " for g in given[n:])
            room -= len(new)
            out += [part[at : m.start()], new]
            at = end
        return "".join(out) + part[at:]

    return put_in(text, 0)


def _accent(m: re.Match) -> str:
    return unicodedata.normalize("NFC", (m[2] or m[3] or m[5]) + COMBINING[m[1] or m[4]])


def plain(text: str) -> str:
    """``text`` in lower case with author macros expanded, and with command names and keys replaced by blanks."""
    if not text.isascii():
        text = INVISIBLE.sub("", SOFT.sub("", unicodedata.normalize("NFKC", text)))
    if "\\" in text:
        defined = macros(text)
        if defined:
            text = expand(text, defined)
        text = KEYED.sub(" ", text)
        text = ACCENT.sub(_accent, text)
    if "-" in text or "\u2010" in text:
        text = HYPHEN.sub("", text)
    if "\\" in text:
        text = FONT.sub(r"\1", text)
        text = COMMAND.sub(" ", text)
    if "{" in text:
        text = PIECE_OF_WORD.sub(r"\1", text)
    return text.lower() if text.isascii() else unicodedata.normalize("NFKC", text.casefold())


def words(text: str | None) -> list[str]:
    """Runs of letters and digits of :func:`plain`."""
    if not text:
        return []
    found = plain(text)
    return (ASCII_WORD if found.isascii() else WORD).findall(found)
