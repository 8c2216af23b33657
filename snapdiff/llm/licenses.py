"""License scans by an exact set-similarity join (native DataFrame functions only)."""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdiff.llm.text import lower_ascii
from snapdiff.session import stored

#: A window meets a template if it has this share of the template's distinct words.
CONTAINMENT = 0.8
#: What stands between words, before and after lower-casing A-Z.
GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: The same but for line feeds.
GAP_IN_LINE = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

#: Fixed phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notice texts: label, text, and the words that tell the license from others
#: (all of them must be in a window that meets the template).
TEMPLATES = [
    ("mit", "Released under the MIT License.", ["mit"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
     ["permission", "granted", "software"]),
    ("apache-2", "Licensed under the Apache License, Version 2.0.", ["apache", "2"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", ["nc", "by"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License.", ["attribution"]),
    ("cc-by-sa", "Licensed under the Creative Commons Attribution-ShareAlike license.", ["sharealike", "attribution"]),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3.", ["gnu", "3"]),
    ("lgpl-3", "This work is licensed under the GNU Lesser General Public License, version 3.", ["gnu", "lesser", "3"]),
    ("agpl-3", "This work is licensed under the GNU Affero General Public License, version 3.", ["gnu", "affero", "3"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted",
     ["redistribution", "binary"]),
    ("all-rights-reserved", "All rights reserved.", ["reserved", "rights"]),
]

Template = tuple[str, str, list[str]]


def all_words(text: str) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate({c: c + 32 for c in range(65, 91)}))


def template_words(text: str) -> list[str]:
    return list(dict.fromkeys(all_words(text)))


def window_step(templates: list[Template]) -> int:
    """Words from the start of one window to the next: the longest template's length."""
    return max((len(all_words(t)) for _, t, _ in templates), default=1)


def need(size: int, containment: float = CONTAINMENT) -> int:
    """Words of a template of ``size`` words that a window must have."""
    return max(1, math.ceil(size * containment - 1e-9))


def spaced(text: Column) -> Column:
    """The words of a text with two blanks around each, so that a phrase with one
    blank at either end matches whole words and neighbours share no blank. The
    case of letters is kept."""
    return F.concat(F.lit("  "), F.regexp_replace(text, GAP, "  "), F.lit("  "))


def word_count(spaced_text: Column) -> Column:
    t = F.trim(spaced_text)
    gaps = (F.octet_length(t) - F.octet_length(F.replace(t, F.lit("  "), F.lit("")))) / 2
    return F.when(F.octet_length(t) == 0, 0).otherwise(gaps + 1).cast("long")


def _phrase(phrase: str) -> str:
    return " " + "  ".join(phrase.split(" ")) + " "


def _meets_itself(phrase: str) -> bool:
    """Whether two places of a phrase can share words ("a b a")."""
    w = phrase.split(" ")
    return any(w[:k] == w[-k:] for k in range(1, len(w)))


def phrase_places(spaced_col: str, folded_col: str, phrases: dict[str, str]) -> dict[str, Column]:
    """Columns ``n_base``, ``first_word``, ``last_word``, ``base_labels`` (array) of a
    text made by :func:`spaced`; places that share words all count.

    ``folded_col`` is that text in lower case by Unicode, which holds a phrase
    wherever the text with A-Z alone lowered does (not the other way round). It
    is cheap to make, so it tells first which texts to look at."""
    s, folded = lower_ascii(F.col(spaced_col)), F.col(folded_col)
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        p = _phrase(phrase)
        if _meets_itself(phrase):
            places = F.regexp_count(s, F.lit(f"(?=\\Q{p}\\E)"))
        else:
            places = (F.octet_length(s) - F.octet_length(F.replace(s, F.lit(p), F.lit("")))) / len(p.encode())
        n = F.when(folded.contains(p), places).otherwise(0).cast("long")
        before = F.substring(s, F.lit(1), F.instr(s, p))
        start = F.length(s) - F.instr(F.reverse(s), p[::-1]) - len(p) + 2
        counts.append(n)
        firsts.append(F.when(n > 0, word_count(before)))
        lasts.append(F.when(n > 0, word_count(F.substring(s, F.lit(1), start))))
        labels.append(F.when(n > 0, F.lit(label)))
    nothing = F.lit(None).cast("long")
    return {
        "n_base": reduce(lambda a, b: a + b, counts),
        "first_word": F.least(*firsts, nothing, nothing),
        "last_word": F.greatest(*lasts, nothing, nothing),
        "base_labels": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }


def _tells(text: Column, templates: list[Template], gap: str) -> Column:
    """Whether a text, its words between ``gap``, has all telling words of a template."""
    each = [reduce(lambda a, b: a & b, [text.contains(f"{gap}{w}{gap}") for w in must], F.lit(True)) for _, _, must in templates]
    return reduce(lambda a, b: a | b, each, F.lit(False))


def _windows(text: Column, templates: list[Template]) -> Column:
    """An array of windows, each the array of its template words, for those windows
    that have all telling words of some template.

    A block is a maximal run of lines with a word. Its windows start at every
    W-th word and are 2W words long (the last ones shorter), W being the longest
    template's length in words: every run of W words lies in one window."""
    vocabulary = sorted({w for _, t, _ in templates for w in template_words(t)})
    lines = F.regexp_replace(F.regexp_replace(lower_ascii(text), GAP_IN_LINE, " "), " ?\n ?", "\n")
    blocks = F.split(lines, "\n\n+", -1)  # two line feeds with no word between them
    piece = f"((?:[^ ]+ ){{1,{window_step(templates)}}})"

    def of_block(block: Column) -> Column:
        pieces = F.regexp_extract_all(F.concat(F.translate(block, "\n", " "), F.lit(" ")), F.lit(piece))
        following = F.slice(pieces, F.lit(2), F.size(pieces))
        return F.zip_with(pieces, following, lambda a, b: F.concat(F.lit(" "), a, F.coalesce(b, F.lit(""))))

    windows = F.filter(F.flatten(F.transform(blocks, of_block)), lambda w: _tells(w, templates, " "))
    return F.transform(windows, lambda w: F.array_intersect(F.array(*map(F.lit, vocabulary)), F.split(w, " ")))


def template_hits(windows: DataFrame, templates: list[Template] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """``id, key, label, containment`` from ``id, key, window, words``: the best
    containment of each label among the templates that the windows of a text meet.

    An exact join of two set collections. The templates' words are ranked by
    the number of windows that hold them, rarest first (words of no template
    cannot overlap and are left out). A window meets a template only if it holds
    one of the template's first |T| - need + 1 words in that order (prefix
    filter), has ``need`` template words at all (length filter), and has enough
    of them from that word on (positional filter). The full overlap is then
    counted, and the template's telling words must all be there. Of two templates
    met by a window, one whose telling words are among the other's gives way.
    Only the word counts (one row a template word) reach the driver; the prefix
    index has at most that many rows a template.
    """
    sets = [template_words(t) for _, t, _ in templates]
    vocabulary = {w for words in sets for w in words}
    frequency = windows.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    held = {r["word"]: r["n"] for r in frequency.collect()}  # at most the templates' words
    order = sorted(vocabulary, key=lambda w: (held.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for t, ((label, _, must), words) in enumerate(zip(templates, sets)):
        ranked = sorted(words, key=rank.__getitem__)
        enough = need(len(ranked), containment)
        above = [u for u, (_, _, other) in enumerate(templates) if set(must) < set(other)]
        index += [(w, i, t, label, ranked, must, above, enough) for i, w in enumerate(ranked[: len(ranked) - enough + 1])]
    prefixes = windows.sparkSession.createDataFrame(
        index, "word string, i int, t int, label string, template array<string>, must array<string>, above array<int>, enough int")
    # array_intersect keeps the order of its first array: words come by rank
    ordered = windows.withColumn("words", F.array_intersect(F.array(*map(F.lit, order)), "words"))
    candidates = ordered.select("id", "key", "window", "words", F.posexplode("words").alias("j", "word"))
    after = F.least(F.size("template") - F.col("i"), F.size("words") - F.col("j"))
    joined = candidates.join(F.broadcast(prefixes), "word").where((F.size("words") >= F.col("enough")) & (after >= F.col("enough")))
    overlap = F.size(F.array_intersect("words", "template"))
    met = joined.where((overlap >= F.col("enough")) & (F.size(F.array_except("must", "words")) == 0)).select(
        "id", "key", "window", F.struct("t", "label", "above", (overlap / F.size("template")).alias("containment")).alias("met"))
    # at most the templates in a group
    of_window = met.groupBy("id", "key", "window").agg(F.collect_set("met").alias("met"))
    left = F.filter("met", lambda x: ~F.arrays_overlap(x["above"], F.col("met")["t"]))
    return of_window.select("id", "key", F.explode(left).alias("met")).groupBy("id", "key", F.col("met.label").alias("label")).agg(
        F.max("met.containment").alias("containment"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  phrases: dict[str, str] = PHRASES, templates: list[Template] = TEMPLATES,
                  containment: float = CONTAINMENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word``,
    ``base_labels, labels`` (distinct, sorted arrays), ``score``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, of the
    whole text; null texts are empty. ``n_base`` counts the places where a
    phrase's words stand consecutively; ``first_word`` / ``last_word`` are the
    least and greatest start (null if none). ``labels`` adds those of the
    templates that a window of a block of lines meets (:func:`template_hits`);
    ``score`` is 1 with a phrase, else the best containment (0 if none).

    Texts are read and split once: what is found, with the template words of the windows
    that can meet a template, is stored in the shared folder. Repeated rows get equal
    results; rows that share an id but not the text are scanned apart; an empty
    table gives an empty table; other columns of ``docs`` are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("_key"), body.alias("_text"), spaced(body).alias("_spaced"))
    rows = rows.withColumn("_folded", F.lower("_spaced"))
    found = stored(rows.select(
        "doc_id", "_key", word_count(F.col("_spaced")).alias("n_words"),
        *[c.alias(k) for k, c in phrase_places("_spaced", "_folded", phrases).items()],
        F.when(_tells(F.col("_folded"), templates, " "), _windows(F.col("_text"), templates)).alias("_windows"),
    ), "license-windows")
    windows = found.where(F.size("_windows") > 0).select(
        F.col("doc_id").alias("id"), F.col("_key").alias("key"), F.posexplode("_windows").alias("window", "words"))
    hits = template_hits(windows, templates, containment).groupBy("id", "key").agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_best"))
    joined = found.drop("_windows").join(hits, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_sort(F.array_union("base_labels", F.coalesce("_labels", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )
