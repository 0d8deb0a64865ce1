import pytest
from pyspark.sql import functions as F

from adspend.llm.licenses import TEMPLATES, Scanner, Template, scan_licenses, words_of

MIT = """Copyright (c) 2019 Some Body
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
and this permission notice shall be included in all copies or substantial portions of the Software."""


def labels(text):
    return {label for label, _, _ in Scanner().scan(text)[3]}


def test_regions():
    t = Template("one <<opt>> two <<opt>> three <<end>> <<end>> four <<var;name=x;min=1;max=2>> five")
    for text, ok in (("one four x five", True), ("one two four x y five", True), ("one two three four x five", True),
                     ("one three four x five", False), ("one four five", False), ("one four x y z five", False),
                     ("one two four x", False), ("ONE, Two: four x five!", True)):
        assert bool(t.spans(words_of(text.lower().encode()))) is ok, text
    assert t.spans(words_of(b"a one four x five one four y five b")) == [(1, 5), (5, 9)]


@pytest.mark.parametrize("markup", ["<<opt>> a", "<<opt>> a <<end>>", "<<var;name=x;max=2>>"])
def test_bad_templates(markup):
    with pytest.raises((ValueError, IndexError)):
        Template(markup)


def test_mandatory_wording_must_match_exactly():
    assert "mit-text" in labels(MIT) and "mit-text" in labels("x " * 400 + MIT.upper() + " y")
    assert "mit-text" not in labels(MIT.replace("merge,", "")) and "mit-text" not in labels(MIT.replace("sell", "sell off"))
    assert labels("This work is licensed under the GNU General Public License, version 3.") == {"gpl-notice"}
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == {"spdx-tag"}
    assert set(TEMPLATES) >= labels("Licensed under CC BY-NC 4.0.") == {"cc-notice"}


def plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    import re
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, names = [], set()
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        for k in range(len(w)):
            if w[k:k + len(p)] == p:
                places.append(k)
                names.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(names))


def test_frame_against_plain_search(docs):
    texts = [None, "", "Released under the MIT License.", "cc by nc cc by nc cc by", "x" * 10 + " Apache License, Version 2.0",
             "apache license version 20", "é CC-BY-NC ü under The mit\nlicense", "under the mit license " * 3000, "ſ under the mit license"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "cc by nc"), (3, "cc by nc")]
    d = docs(rows).withColumn("labels", F.lit(1)).withColumn("n_words", F.lit("clash"))
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scan_licenses(d).collect()]
    assert sorted(got, key=repr) == sorted(((i, *plain(t)) for i, t in rows), key=repr)
    for r in scan_licenses(d).collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert scan_licenses(docs([])).collect() == []
