"""Licence scans with a generalised suffix automaton of licence words.

The words of all licence templates and phrases form one suffix automaton
(separate sequences, shared states). A text is streamed through it word by word;
the automaton gives the matching statistics: for each word, the longest run of
words ending there that occurs in some template. Runs that cannot be extended
are matches; matches of one template that follow one another in text and
template order are chained, across small gaps, into spans. A span that covers
enough of its template labels the text with the template's licence. The places
of the base phrases come from the same pass: a phrase ends at a word when the
current match is at least as long as the phrase and the phrase is a suffix of
it, which is kept per state.

Words are runs of digits, lower-cased letters A-Z and any non-ASCII characters;
everything else in ASCII separates them.

Defined results: a NULL or empty text has no words, no places, empty labels and
score 0; first_word and last_word are NULL without a base place; repeated rows
are scanned one by one; an empty table gives an empty result; other columns are
ignored. A very long text is streamed through the automaton; only its word list
is held.
"""

from __future__ import annotations

from bisect import bisect
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from basketry.llm.common import map_batches, table

# The phrases of the contract and their labels.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Notices and key sentences of well-known public licences, as their stewards publish them.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "Released under the MIT License."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, "
            "or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
            "License 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
            "to this work."),
)

MIN_RUN = 3        # shortest run of words that may open or extend a chain
MAX_GAP = 6        # words that a chain may skip, in the text or in the template
MIN_COVER = 0.75   # share of the template that a span must cover to label the text

# every ASCII byte that is no digit or letter separates words; A-Z are lowered first
_SEPARATE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of the text in UTF-8, A-Z lowered."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_SEPARATE).split()


@dataclass
class _Node:
    length: int = 0
    link: int = -1
    next: dict = field(default_factory=dict)
    ends: dict = field(default_factory=dict)      # template -> word positions where the state's runs end
    phrases: tuple = ()                            # base phrases that are suffixes of the state's runs


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences."""

    def __init__(self, templates, phrases):
        self.labels = [label for label, _ in templates]
        self.sequences = [words_of(text) for _, text in templates]
        self.phrases = [(tuple(words_of(p)), label) for p, label in phrases]
        self.nodes = [_Node()]
        for t, sequence in enumerate([*self.sequences, *(list(p) for p, _ in self.phrases)]):
            last = 0
            for i, word in enumerate(sequence):
                last = self._extend(last, word)
                if t < len(self.sequences):
                    self.nodes[last].ends.setdefault(t, set()).add(i)
        order = sorted(range(1, len(self.nodes)), key=lambda n: -self.nodes[n].length)
        for n in order:  # a state's runs also end wherever those of the states linked to it end
            link = self.nodes[self.nodes[n].link]
            for t, at in self.nodes[n].ends.items():
                link.ends.setdefault(t, set()).update(at)
        for k, (words, _) in enumerate(self.phrases):
            state = 0
            for w in words:
                state = self.nodes[state].next[w]
            for n in range(1, len(self.nodes)):
                up = n
                while up > 0 and up != state:
                    up = self.nodes[up].link
                if up == state:
                    self.nodes[n].phrases = (*self.nodes[n].phrases, k)
        self.vocabulary = frozenset(w for s in self.sequences for w in s) | {w for p, _ in self.phrases for w in p}

    def _extend(self, last: int, word: bytes) -> int:
        nodes = self.nodes
        known = nodes[last].next.get(word)
        if known is not None:
            if nodes[known].length == nodes[last].length + 1:
                return known
            return self._clone(last, word, known)
        new = len(nodes)
        nodes.append(_Node(length=nodes[last].length + 1))
        at = last
        while at != -1 and word not in nodes[at].next:
            nodes[at].next[word] = new
            at = nodes[at].link
        if at == -1:
            nodes[new].link = 0
        else:
            target = nodes[at].next[word]
            nodes[new].link = (target if nodes[target].length == nodes[at].length + 1
                               else self._clone(at, word, target))
        return new

    def _clone(self, at: int, word: bytes, target: int) -> int:
        nodes = self.nodes
        copy = len(nodes)
        nodes.append(_Node(length=nodes[at].length + 1, link=nodes[target].link, next=dict(nodes[target].next)))
        nodes[target].link = copy
        while at != -1 and nodes[at].next.get(word) == target:
            nodes[at].next[word] = copy
            at = nodes[at].link
        return copy

    def stream(self, words: list[bytes]):
        """(position, matched length, state) for each word inside some match: the matching statistics above 0."""
        nodes, vocabulary = self.nodes, self.vocabulary
        state, length, before = 0, 0, -2
        for i in [i for i, w in enumerate(words) if w in vocabulary]:
            if i != before + 1:  # a word of no template ends every match
                state, length = 0, 0
            before, w = i, words[i]
            while state and w not in nodes[state].next:
                state = nodes[state].link
                length = nodes[state].length
            state = nodes[state].next.get(w, 0)
            length = length + 1 if state else 0
            yield i, length, state


@dataclass
class _Piece:
    """A run at one of its places in a template, with the best chain that ends with it."""

    start: int        # first word in the text
    end: int          # last word in the text
    at: int           # last word in the template
    length: int
    covered: int      # template words that the chain covers
    more: int         # those that this piece adds
    before: _Piece | None = None


def scan_words(auto: SuffixAutomaton, words: list[bytes]) -> tuple[list, list]:
    """Places (first word, phrase) of the base phrases, and chained spans (template, first word, last word, cover)."""
    places: list[tuple[int, int]] = []
    runs: list[tuple[int, int, int]] = []
    held: tuple[int, int, int] | None = None
    for i, length, state in auto.stream(words):
        for k in auto.nodes[state].phrases:
            size = len(auto.phrases[k][0])
            if length >= size:
                places.append((i - size + 1, k))
        # a match that the next word does not extend by one is as long as it gets
        if held is not None and (i != held[0] + 1 or length != held[1] + 1) and held[1] >= MIN_RUN:
            runs.append(held)
        held = (i, length, state)
    if held is not None and held[1] >= MIN_RUN:
        runs.append(held)
    return places, _chain(auto, runs)


def _chain(auto: SuffixAutomaton, runs) -> list[tuple[int, int, int, float]]:
    """Chain runs that follow one another in one template into spans (template, first word, last word, cover).

    A run counts at each of its places in the template, and for each of them the chain that covers most is kept.
    """
    open_pieces: dict[int, list[_Piece]] = {}
    done: list[tuple[int, int, int, int]] = []
    for end, length, state in runs:
        start = end - length + 1
        for t, ends in auto.nodes[state].ends.items():
            earlier = open_pieces.get(t, [])
            if earlier and start - earlier[-1].end - 1 > MAX_GAP:  # nothing can be chained to what came before
                done += _spans(t, earlier)
                earlier = []
            open_pieces[t] = earlier + [_extended(_Piece(start, end, at, length, length, length), earlier)
                                        for at in sorted(ends)]
    for t, pieces in open_pieces.items():
        done += _spans(t, pieces)
    return sorted((t, a, b, covered / len(auto.sequences[t])) for t, a, b, covered in done)


def _extended(piece: _Piece, earlier: list[_Piece]) -> _Piece:
    """The piece after the chain of an earlier one that makes it cover most, the nearest of equal ones."""
    for p in reversed(earlier):  # their ends never decrease
        if piece.start - p.end - 1 > MAX_GAP:
            break
        overlap = max(0, p.end - piece.start + 1, p.at - (piece.at - piece.length + 1) + 1)
        gap = piece.at - piece.length - p.at
        if p.end < piece.end and p.at < piece.at and overlap < piece.length and gap <= MAX_GAP:
            covered = p.covered + piece.length - overlap
            if covered > piece.covered:
                piece.covered, piece.more, piece.before = covered, piece.length - overlap, p
    return piece


def _spans(t: int, pieces: list[_Piece]) -> list[tuple[int, int, int, int]]:
    """Disjoint chains (template, first word, last word, covered words), those that cover most first."""
    used: set[int] = set()
    taken: list[tuple[int, int]] = []
    out = []
    for last in sorted(pieces, key=lambda p: (-p.covered, p.end, p.at)):
        if id(last) in used:
            continue
        piece, covered = last, 0
        used.add(id(piece))
        while piece.before is not None and id(piece.before) not in used:
            covered, piece = covered + piece.more, piece.before
            used.add(id(piece))
        span = (piece.start, last.end)
        i = bisect(taken, span)
        if (i and taken[i - 1][1] >= span[0]) or (i < len(taken) and taken[i][0] <= span[1]):
            continue  # words of a better chain
        taken.insert(i, span)
        out.append((t, *span, covered + piece.length))
    return out


SPANS = "array<struct<label: string, first_word: long, last_word: long, cover: double>>"
SCAN = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        f"score double, spans {SPANS}")


def scan_text(auto: SuffixAutomaton, text: str | None) -> tuple:
    words = words_of(text)
    places, found = scan_words(auto, words)
    starts = [at for at, _ in places]
    base = {auto.phrases[k][1] for _, k in places}
    spans = [s for s in found if s[3] >= MIN_COVER]
    labels = base | {auto.labels[t] for t, *_ in spans}
    score = 1.0 if base else min(1.0, max((s[3] for s in found), default=0.0))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score,
            [{"label": auto.labels[t], "first_word": a, "last_word": b, "cover": share} for t, a, b, share in spans])


def scan_documents(docs: DataFrame, templates=TEMPLATES, phrases=BASE_PHRASES) -> DataFrame:
    """Per document: words, base places, labels, score and the covered template spans."""
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")

    def work(batches):
        auto = SuffixAutomaton(templates, phrases)
        for b in batches:
            rows = [scan_text(auto, t) for t in b["text"]]
            yield {"doc_id": b["doc_id"], **{n: [r[i] for r in rows] for i, n in enumerate(names)}}

    return map_batches(docs, ["doc_id", "text"], SCAN, work)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: licence places, labels and score of every document."""
    return scan_documents(table(spark, sf_dir, "documents")).drop("spans")
