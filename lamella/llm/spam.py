"""Keyword-stuffed and link-list pages, by robust Mahalanobis distance per language.

Every document gets features of density (words in lists, links, tags), repetition, entropy, function words and
sentences. Per language, a location and a scatter that outliers cannot pull are estimated from Spark aggregates: medians
and deviations from them first, then a few rounds of mean and covariance over the rows within the cut-off. Both are
drawn towards those of all documents, the more the fewer rows a language has, so every language is judged in one way
whatever its size. A document is flagged if its distance is beyond the cut-off and its step from the location lies in
the spam-ward direction: projected, in the scatter's metric, on the step to a page of lists alone, it goes more than
half of that way.

Null, empty and blank texts, and documents cut off before their body, have no body and are never found. The estimates
hold one row per language, so what reaches the driver doesn't grow with the corpus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.llm.latex_words import closer
from lamella.session import cut

# Common function words by language.
FUNCTION_WORDS = {
    "en": "the of and a an in to is are for with that by as we this it its on be no not each both but from at or which when our every",
    "de": "der die das und ein eine ist sind nicht mit von für auf den dem des zu im wir sich auch bei wird oder als",
    "fr": "le la les des une un et est sont dans pour avec que qui sur par au aux nous ne pas ce cette du ou",
    "es": "el la los las una un y es son en para con que por del se su no al como más este esta lo",
    "pt": "o a os as um uma e é são em para com que por do da dos das não se no na ao está até também",
    "ru": "и в не на что с по для как это из к от же но при мы или между также его",
    "zh": "的 是 在 和 了 与 对 中 为 我们 这 以 及 其 有 不 上 从 而",
}
LANGUAGE = {w: {lang for lang, ws in FUNCTION_WORDS.items() if w in ws.split()} for ws in FUNCTION_WORDS.values() for w in ws.split()}

WORD = re.compile(r"[^\W_]+")
COMMENT = re.compile(r"(?<!\\)%[^\n]*")
COMMENT_BLOCK = re.compile(r"\\begin\{comment\}.*?(?:\\end\{comment\}|\Z)", re.S)
FRONT = re.compile(r"\\(?:title|author|date|thanks|affiliation|address|email)\s*(?:\[[^\]]*\])?\s*(?=\{)|\\maketitle")
END = "\\end{document}"
#: A bibliography's own span: the environment, the rest of one that a fragment begins in, or the one command.
REFERENCES = re.compile(r"\\begin\{thebibliography\}.*?(?:\\end\{thebibliography\}|\Z)|\\bibliography(?:style)?\s*\{[^{}]*\}|\\printbibliography(?:\s*\[[^\]]*\])?", re.S)
REST = re.compile(r"\\bibitem.*?\\end\{thebibliography\}", re.S)
ENTRY = re.compile(r"\\bibitem.*?(?=\\bibitem|\n[ \t\r]*\n|\\(?:sub)*section\b|\\appendix\b|\Z)", re.S)
SETTING = re.compile(r"\\(?:documentclass|usepackage|(?:re)?newcommand|providecommand|DeclareMathOperator|def\\|newtheorem|input|include)[^\n]*")
#: Formulas and tables: their words are of the body, but never spam.
FORMULA = re.compile(r"\\begin\{(equation|align|displaymath|eqnarray|gather|multline|math|tabular|tabularx|table|longtable|array|figure|algorithm|algorithmic|verbatim|lstlisting)\*?\}.*?(?:\\end\{\1\*?\}|\Z)|\$\$.*?\$\$|\\\[.*?\\\]", re.S)
INLINE = re.compile(r"\$[^$\n]+\$|\\\([^\n]+?\\\)")
LINK = re.compile(r"\\(?:url|href|nolinkurl)\s*\{[^{}]*\}|(?:https?://|www\.)[^\s{}]+", re.I)
TAG = re.compile(r"(?:\\#|#)\w+|\bSKU\b")
KEYED = re.compile(r"\\(?:[A-Za-z]*cite[a-z]*|(?:page|eq|auto|c|C)?ref|label)\*?(?:\[[^\]]*\])*\{[^{}]*\}")
COMMAND = re.compile(r"\\(?:begin|end)\{[^{}]*\}|\\[A-Za-z@]+\*?|\\.")
BREAK = re.compile(r"\n[ \t\r]*\n|\\(?:sub)*section\*?\s*(?=\{)|\\par\b|\\begin\{[^{}]*\}|\\end\{[^{}]*\}")
STOP = re.compile(r"(?<=[^\s.][.!?])(?=[\s})\]\"']|$)|(?<=[。！？])")

#: ``listed``: share of the body's words in units of repeated keywords, link entries or tags, outside sentences, formulas and tables.
FEATURES = ("listed", "links", "tags", "top", "repeats", "entropy", "function", "sentences")
#: The values of a page of lists alone, where the kind of list doesn't matter; the other features only add to the distance.
LISTS_ALONE = {"listed": 1.0, "function": 0.0, "sentences": 0.0}
#: The least spread of each feature that counts, so that a constant feature can't divide by zero.
LEAST_SPREAD = (0.03, 0.02, 0.02, 0.03, 0.04, 0.05, 0.04, 0.08)
#: Rows at which a language's own estimate and the common one weigh the same.
PRIOR_ROWS = 50.0


def _without_front(text: str) -> str:
    """``text`` without title, author and the like, whose arguments may nest to any depth."""
    out, at, close = [], 0, closer(text)
    for m in FRONT.finditer(text):
        last = m.end() - 1 if m[0].startswith("\\maketitle") else close(m.end())
        if m.start() >= at and last is not None:
            out += [text[at : m.start()], " "]
            at = last + 1
    return "".join(out) + text[at:]


def body(text: str | None) -> str | None:
    """A document without preamble, title, author, bibliography and comments; None if it ends before its body."""
    if not text or not text.strip():
        return None
    # a commented command begins or ends nothing
    if "%" in text:
        text = COMMENT.sub("", text)
    if "\\begin{comment}" in text:
        text = COMMENT_BLOCK.sub(" ", text)
    begin = text.find("\\begin{document}")
    if begin >= 0:
        text = text[begin + 16 :]
    elif "\\documentclass" in text:
        return None
    text = text.partition(END)[0]
    if "bib" in text:
        text = REFERENCES.sub("\n\n", text)
        if "\\bibitem" in text:
            text = ENTRY.sub("\n\n", REST.sub("\n\n", text))
    text = _without_front(text)
    return SETTING.sub(" ", text) if begin < 0 else text


def units(main: str) -> Iterator[tuple[str, bool]]:
    """Sentences and unfinished units of a body without formulas: (text, ends as a sentence does)."""
    for block in BREAK.split(main):
        if not block or block.isspace():
            continue
        for part in STOP.split(block):
            if part and not part.isspace():
                yield part, part.rstrip(" \n\r\t}\"')]")[-1:] in (".", "!", "?", "。", "！", "？")


def measure(text: str | None) -> tuple | None:
    """Language, words and features of a document; None without a body of words."""
    b = body(text)
    if b is None:
        return None
    formulas = 0

    def formula(m: re.Match) -> str:
        nonlocal formulas
        formulas += len(WORD.findall(COMMAND.sub(" ", m[0])))
        return " \n\n "

    main = FORMULA.sub(formula, b)
    main = INLINE.sub(" 0 ", main)
    main = KEYED.sub(" ", main)
    parts = []
    for part, ended in units(main):
        links = LINK.findall(part) if ("\\url" in part or "\\href" in part or "://" in part or "www." in part) else ()
        tags = len(TAG.findall(part)) if "#" in part or "SKU" in part else 0
        linked = sum(len(WORD.findall(x)) for x in links) - len(links) if links else 0
        ws = WORD.findall(COMMAND.sub(" ", part).lower() if "\\" in part else part.lower())
        if ws:
            parts.append((ws, ended, len(links), linked, tags))
    total = sum(len(p[0]) for p in parts)
    if not total:
        return None
    count = Counter(w for ws, *_ in parts for w in ws)
    loose = Counter(w for ws, ended, *_ in parts if not ended for w in ws)
    spam = sentences = in_links = in_tags = repeats = pairs = 0
    for ws, ended, n_links, linked, tags in parts:
        n = len(ws)
        in_links += linked
        in_tags += tags
        bigrams = Counter(zip(ws, ws[1:]))
        repeats += sum(c for c in bigrams.values() if c > 2)
        pairs += max(n - 1, 0)
        same = n >= 8 and len(set(ws)) < 0.35 * n
        if ended and not same:
            sentences += n
            continue
        listed = n_links and linked >= 0.3 * n
        tagged = tags >= 2
        if same or listed or tagged or sum(loose[w] >= 4 for w in ws) >= 0.7 * n:
            spam += n
    entropy = -sum(c / total * log(c / total) for c in count.values()) / max(log(total), 1.0)
    # words of a pair of languages count for both; texts without function words have no language
    votes = Counter(lang for w, c in count.items() for lang in LANGUAGE.get(w, ()) for _ in range(min(c, 50)))
    cjk = sum(c for w, c in count.items() if "\u4e00" <= w[0] <= "\u9fff")
    lang, n_function = ("zh", sum(c * sum(x in w for x in ("的", "是", "在", "和", "与", "对", "为")) for w, c in count.items() if "\u4e00" <= w[0] <= "\u9fff")) if cjk > 0.3 * total else (votes.most_common(1) or [("none", 0)])[0]
    if cjk <= 0.3 * total:
        n_function = sum(c for w, c in count.items() if lang in LANGUAGE.get(w, ()))
    if n_function < 0.02 * total:
        lang = "none"
    top = sum(c for w, c in count.most_common(12) if w not in LANGUAGE) / total
    return lang, total + formulas, spam / (total + formulas), in_links / total, min(in_tags / total, 1.0), top, repeats / max(pairs, 1), entropy, min(n_function / total, 1.0), sentences / total


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang, n_words`` and the features of every document with a body."""
    kind = docs.schema[key].dataType

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *m) for k, t in zip(pdf.iloc[:, 0], pdf.iloc[:, 1]) if isinstance(t, str) and (m := measure(t)) is not None]
            yield pd.DataFrame(rows, columns=[key, "lang", "n_words", *FEATURES])

    return docs.select(key, text).where(F.col(text).isNotNull() & F.col(key).isNotNull()).mapInPandas(work, f"{key} {kind.simpleString()}, lang string, n_words bigint, " + ", ".join(f"{f} double" for f in FEATURES))


Model = dict[str, tuple[np.ndarray, np.ndarray]]
COMMON = "all"


def _distance(model: Model) -> tuple[Column, Column]:
    """Squared distance of a row and the part of the way to a page of lists that it goes, by its group's location and inverse scatter."""
    distance, toward = F.lit(None).cast("double"), F.lit(None).cast("double")
    for grp, (centre, inverse) in model.items():
        d = [F.col(f) - F.lit(float(c)) for f, c in zip(FEATURES, centre)]
        square = sum((F.lit(float(inverse[i, j] * (1 if i == j else 2))) * d[i] * d[j] for i in range(len(d)) for j in range(i, len(d))), F.lit(0.0))
        step = np.array([LISTS_ALONE[f] - c if f in LISTS_ALONE else 0.0 for f, c in zip(FEATURES, centre)])
        pull = inverse @ step / (step @ inverse @ step)
        here = F.col("grp") == grp
        distance, toward = F.when(here, square).otherwise(distance), F.when(here, sum((F.lit(float(w)) * x for w, x in zip(pull, d)), F.lit(0.0))).otherwise(toward)
    return distance, toward


def _drawn(own: dict[str, tuple[float, np.ndarray]]) -> dict[str, np.ndarray]:
    """Estimates per group (rows, value) drawn towards the common one."""
    common = own[COMMON][1]
    return {g: (n * v + (0.0 if g == COMMON else PRIOR_ROWS) * common) / (n + (0.0 if g == COMMON else PRIOR_ROWS)) for g, (n, v) in own.items()}


def robust_model(rows: DataFrame, cutoff: float, rounds: int = 3) -> Model:
    """Location and inverse scatter per ``grp``: medians and deviations, then moments of the rows within the cut-off."""
    width = len(FEATURES)
    median = rows.groupBy("grp").agg(F.count("*").alias("n"), *[F.percentile_approx(f, 0.5, 2000).alias(f) for f in FEATURES]).collect()
    if not median:
        return {}
    centre = _drawn({r["grp"]: (r["n"], np.array([r[f] for f in FEATURES])) for r in median})

    def from_centre(i: int) -> Column:
        out = F.lit(None).cast("double")
        for g, c in centre.items():
            out = F.when(F.col("grp") == g, F.lit(float(c[i]))).otherwise(out)
        return F.abs(F.col(FEATURES[i]) - out)

    spread = rows.groupBy("grp").agg(F.count("*").alias("n"), *[F.percentile_approx(from_centre(i), 0.5, 2000).alias(f) for i, f in enumerate(FEATURES)])
    spread = _drawn({r["grp"]: (r["n"], 1.4826 * np.array([r[f] for f in FEATURES])) for r in spread.collect()})
    model = {g: (centre[g], np.diag(1 / np.maximum(spread[g], LEAST_SPREAD) ** 2)) for g in centre}
    sums = [F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)] + [F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c{i}_{j}") for i in range(width) for j in range(i, width)]
    for _ in range(rounds):
        inner = rows.withColumn("d2", _distance(model)[0]).where(F.col("d2") <= cutoff)
        found = {r["grp"]: r for r in inner.groupBy("grp").agg(F.count("*").alias("n"), *sums).collect()}
        if COMMON not in found:
            break
        # a group without a row within the cut-off keeps the common estimate
        n = {g: found[g]["n"] if g in found else 0 for g in model}
        mean = {g: (n[g], np.array([found[g if n[g] else COMMON][f"m{i}"] for i in range(width)])) for g in model}
        cov = {g: (n[g], np.array([[found[g if n[g] else COMMON][f"c{min(i, j)}_{max(i, j)}"] for j in range(width)] for i in range(width)])) for g in model}
        mean, cov = _drawn(mean), _drawn(cov)
        model = {g: (mean[g], np.linalg.inv(cov[g] + np.diag(np.square(LEAST_SPREAD)))) for g in model}
    return model


def outliers(docs: DataFrame, key: str = "doc_id", text: str = "text", cutoff: float = 26.1, way: float = 0.5) -> DataFrame:
    """``scored`` plus ``grp``, ``distance`` (squared), ``toward`` and ``outlier``.

    ``cutoff``: squared distance (99.9 % of eight normal features). ``way``: the part of the way to a page of lists that
    an outlier goes at least. Documents without a language are judged by the model of all documents.
    """
    rows = cut(scored(docs, key, text)).withColumn("grp", F.when(F.col("lang") == "none", COMMON).otherwise(F.col("lang")))
    every = rows.unionByName(rows.where(F.col("grp") != COMMON).withColumn("grp", F.lit(COMMON)))
    distance, toward = _distance(robust_model(every, cutoff))
    return rows.withColumn("distance", distance).withColumn("toward", toward).withColumn("outlier", (F.col("distance") > cutoff) & (F.col("toward") > way))


def spam_found(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Keys of the spam-ward outliers."""
    return outliers(docs, key, text).where("outlier").select(key).distinct()
