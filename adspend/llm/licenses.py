"""License scans by template markup.

A license text is given as a template: mandatory wording, optional regions
``<<opt>> ... <<end>>`` (they nest) and replaceable regions
``<<var;name=N;max=K>>`` that stand for 0 to K words (``min=``, if given, for
at least so many). A template is compiled to an automaton over words:
mandatory words are transitions on that word, an optional region may be passed
over, a replaceable one takes any words. A stretch of a text is accepted only
if all mandatory wording is there exactly, in order, with nothing between.

Whole texts are scanned. A text is only run through a template's automaton
where the template's longest mandatory run of words occurs in it, which every
accepted text must hold.

Words are the stretches of letters A-Z (lowered), digits and non-ASCII
characters. Base phrases are reported wherever their words stand
consecutively. Defined results: a null text counts as empty; no place gives
null first and last words, empty label lists and a score of 0.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import add_columns
from .words import ALNUM, LOWER

# The base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wording of public license notices.
TEMPLATES = {
    "mit-text": """
        <<opt>> <<opt>> the <<end>> mit license <<end>>
        <<opt>> copyright <<opt>> c <<end>> <<var;name=holders;max=20>> <<end>>
        Permission is hereby granted, free of charge, to any person obtaining a copy of
        <<var;name=software;min=1;max=8>> (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice
        <<opt>> (including the next paragraph) <<end>> shall be included in all copies or substantial
        portions of the Software.
        <<opt>> THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. <<end>>""",
    "mit-notice": """
        <<opt>> this <<var;name=work;min=1;max=4>> is <<end>> <<opt>> licensed <<end>> <<opt>> released <<end>>
        <<opt>> distributed <<end>> under <<opt>> the terms of <<end>> the MIT license""",
    "apache-2-notice": """
        Licensed under the Apache License, Version 2.0 <<opt>> (the "License") <<end>>
        <<opt>> you may not use <<var;name=work;min=1;max=6>> except in compliance with the License <<end>>""",
    "gpl-notice": """
        <<opt>> this <<var;name=work;min=1;max=4>> is <<end>> licensed under the GNU
        <<opt>> lesser <<end>> <<opt>> affero <<end>> general public license
        <<opt>> as published by the free software foundation <<end>>
        <<opt>> either <<end>> version <<var;name=version;min=1;max=1>>""",
    "cc-notice": """
        <<opt>> this <<var;name=work;min=1;max=4>> is <<end>> licensed under
        <<opt>> a <<end>> <<opt>> the <<end>> <<opt>> creative commons <<end>> CC BY
        <<opt>> NC <<end>> <<opt>> SA <<end>> <<opt>> ND <<end>> <<opt>> <<var;name=version;min=2;max=2>> <<end>>""",
    "bsd-text": """
        Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: <<var;name=mark;max=1>>
        Redistributions of source code must retain the above copyright notice, this list of conditions
        and the following disclaimer. <<var;name=mark;max=1>>
        Redistributions in binary form must reproduce the above copyright notice, this list of conditions
        and the following disclaimer in the documentation and/or other materials provided with the
        distribution. <<opt>> <<var;name=mark;max=1>> Neither the name of <<var;name=holder;min=1;max=12>> nor
        the names of its contributors may be used to endorse or promote products derived from this
        software without specific prior written permission. <<end>>""",
    "spdx-tag": "SPDX-License-Identifier <<var;name=id;min=1;max=4>>",
}

_TABLE = bytes(int(LOWER[b]) if ALNUM[b] else 32 for b in range(256))
_ANY = b""  # a transition on any word


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Template:
    """A template's automaton: states with transitions on words and free moves."""

    def __init__(self, markup: str):
        self.steps: list[list[tuple[bytes, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        runs: list[list[bytes]] = [[]]
        at, opened = 0, []
        for kind, body, text in re.findall(r"<<(opt|end|var)([^>]*)>>|([^<]+)", markup):
            if kind == "opt":
                opened.append(at)
                at = self._state(at)
            elif kind == "end":
                end = self._state(at)
                self.free[opened.pop()].append(end)
                at = end
            elif kind == "var":
                span = dict(x.split("=") for x in body.strip(";").split(";"))
                at, least = self._state(at), int(span.get("min", 0))
                for k in range(int(span["max"])):
                    after = self._state()
                    self.steps[at].append((_ANY, after))
                    if k >= least:
                        self.free[at].append(after)
                    at = after
            else:
                for w in words_of(text.encode()):
                    after = self._state()
                    self.steps[at].append((w, after))
                    at = after
                    if not opened:
                        runs[-1].append(w)
            if kind:
                runs.append([])
        if opened:
            raise ValueError("an optional region is not ended")
        self.accept = at
        self.core = b" " + b" ".join(max(runs, key=lambda r: len(b" ".join(r)))) + b" "
        if not self.core.strip():
            raise ValueError("a template needs mandatory words")
        self.closed = [self._closure(s) for s in range(len(self.steps))]

    def _state(self, before: int | None = None) -> int:
        self.steps.append([])
        self.free.append([])
        if before is not None:
            self.free[before].append(len(self.steps) - 1)
        return len(self.steps) - 1

    def _closure(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def spans(self, words: list[bytes]) -> list[tuple[int, int]]:
        """Longest accepted stretches by their first word, one behind the other."""
        heads = {w for s in self.closed[0] for w, _ in self.steps[s]}
        out, at = [], 0
        while at < len(words):
            end = self._longest(words, at) if _ANY in heads or words[at] in heads else None
            if end is None:
                at += 1
            else:
                out.append((at, end))
                at = max(end, at + 1)
        return out

    def _longest(self, words: list[bytes], at: int) -> int | None:
        states, end = self.closed[0], None
        for k in range(at, len(words)):
            states = frozenset().union(*(self.closed[t] for s in states for w, t in self.steps[s]
                                         if w == _ANY or w == words[k]))
            if not states:
                break
            if self.accept in states:
                end = k + 1
        return end


class Scanner:
    def __init__(self, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES):
        self.phrases = [(b" " + b" ".join(words_of(p.encode())) + b" ", label) for p, label in phrases.items()]
        self.templates = [(label, Template(markup)) for label, markup in templates.items()]

    def scan(self, text: str | None) -> tuple[int, list[int], set[str], list[tuple[str, int, int]]]:
        """(number of words, places of base phrases, their labels, template spans)."""
        words = words_of((text or "").encode())
        line = b" " + b" ".join(words) + b" "
        places, labels, spans = [], set(), []
        for phrase, label in self.phrases:
            at = line.find(phrase)
            while at >= 0:
                places.append(line.count(b" ", 0, at))
                labels.add(label)
                at = line.find(phrase, at + 1)
        for label, template in self.templates:
            if template.core in line:
                spans += [(label, a, b) for a, b in template.spans(words)]
        return len(words), places, labels, spans


SPAN = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
                                 T.StructField("end_word", T.LongType())]))


def scan_licenses(docs: DataFrame, text_col: str = "text", phrases: Mapping[str, str] = PHRASES,
                  templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """``docs`` without the text, with n_words, n_base, first_word, last_word,
    base_labels, labels, score and the template ``spans`` (label, first word, word behind the last).

    The score is 1 where a template accepts a stretch, 0.5 where only a base
    phrase stands, else 0.
    """
    phrases, templates = dict(phrases), dict(templates)

    def make():
        scanner = Scanner(phrases, templates)

        def work(cols):
            rows = [scanner.scan(t) for t in cols[0].to_pylist()]
            own = [sorted({label for label, _, _ in s}) for _, _, _, s in rows]
            return [
                pa.array([n for n, _, _, _ in rows], pa.int64()),
                pa.array([len(p) for _, p, _, _ in rows], pa.int64()),
                pa.array([min(p, default=None) for _, p, _, _ in rows], pa.int64()),
                pa.array([max(p, default=None) for _, p, _, _ in rows], pa.int64()),
                pa.array([",".join(sorted(b)) for _, _, b, _ in rows], pa.string()),
                pa.array([",".join(sorted(b.union(o))) for (_, _, b, _), o in zip(rows, own, strict=True)], pa.string()),
                pa.array([1.0 if s else 0.5 if p else 0.0 for _, p, _, s in rows], pa.float64()),
                pa.array([[{"label": x, "first_word": a, "end_word": b} for x, a, b in s] for _, _, _, s in rows],
                         pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()),
                                             ("end_word", pa.int64())]))),
            ]
        return work

    outputs = [("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()),
               ("last_word", T.LongType()), ("base_labels", T.StringType()), ("labels", T.StringType()),
               ("score", T.DoubleType()), ("spans", SPAN)]
    return add_columns(docs, [text_col], outputs, make, (text_col,))
