import itertools
import re

import pytest

from flowlens.llm import license_scan as L

from .helpers import documents, odd_rows


def as_regex(template):
    out = []
    for mark, word in L._MARKUP.findall(template):
        if word:
            out.append(re.escape(word.lower()) + " ")
        elif mark == "beginOptional":
            out.append("(?:")
        elif mark == "endOptional":
            out.append(")?")
        else:
            b = {"min": 0, "max": 8} | {k: int(v) for k, v in (p.split("=") for p in mark.split(";")[1:])}
            out.append(r"(?:\S+ ){%d,%d}" % (b["min"], b["max"]))
    return re.compile("".join(out))


CASES = ["licensed under the apache license version 2 0", "Licensed under the Apache License 2.0!", "licensed under the apache license 3",
         "this work is licensed under the gnu general public license version 3 or any later version", "copyright c 2020 someone all rights reserved",
         "copyright " + "x " * 13 + "all rights reserved", "spdx license identifier mit", "released under the terms of the mit license",
         "licensed under cc by nc 4 0", "licensed under a creative commons attribution 4 0 international license", "cc by cc by", "mit license"]


@pytest.mark.parametrize("label,template", L.TEMPLATES)
def test_automaton_against_regex(label, template):
    a, r = L.Automaton(template), as_regex(template)
    plain = re.sub(r"<<.*?>>", " ", template)
    without = re.sub(r"<<beginOptional>>.*?<<endOptional>>", " ", template)
    for text in [*CASES, plain, re.sub("<<.*?>>", " x ", without), without.replace("license", "licence"), re.sub(r"<<.*?>>", " any ", template) + " more words"]:
        words = L.words_of(text)
        line = [w.decode() + " " for w in words]
        for at in range(len(words)):
            # the longest acceptance, by trying every end
            ends = [e for e in range(at + 1, len(words) + 1) if r.fullmatch("".join(line[at:e]))]
            assert a.longest(words, at) == max(ends, default=-1)


def test_markup_errors():
    with pytest.raises(ValueError):
        L.Automaton("a <<beginOptional>> b")
    with pytest.raises(ValueError):
        L.Automaton("<<var;min=1;max=2>> a").first_words()


def test_documents(spark):
    rows = odd_rows([(20 + k, c) for k, c in enumerate(CASES)] + [(40, "CC-BY cc by; All Rights\nReserved é all rights reserved")])
    got = {}
    for r in L.scan_licenses(documents(spark, rows)).collect():
        got.setdefault(r.doc_id, r)
        assert 0 <= r.score <= 1
    assert len(L.scan_licenses(documents(spark, rows)).collect()) == len(rows)
    words = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for doc, text in rows:
        w = words.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        places = [(k, label) for (phrase, label), k in itertools.product(L.BASE, range(len(w))) if w[k:k + len(phrase.split())] == phrase.split()]
        r = got[doc]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == (min((k for k, _ in places), default=None), max((k for k, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    assert got[20].labels == "apache-2.0" and got[22].labels == "" and got[27].labels == "mit"
    assert got[24].labels == "copyright,reserved" and got[25].labels == "reserved"
    assert L.scan_licenses(documents(spark, [])).collect() == []


def labels(text):
    return L.Matcher().match(text)[5].split(",")


GRANT = ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
         "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
         "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
         "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n")
AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
         "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
         "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
         "OTHER DEALINGS IN THE SOFTWARE.\n")
X11 = ("Except as contained in this notice, the name of Some Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings "
       "in this Software without prior written authorization from Some Consortium.\n")
BSD = ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n",
       "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n",
       "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
       "and/or other materials provided with the distribution.\n",
       "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software "
       "developed by the organization.\n",
       "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
       "without specific prior written permission.\n",
       'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
       "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
       "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
       "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
       "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."]


@pytest.mark.parametrize("text,expected", [
    (GRANT + AS_IS, "mit"), (GRANT + AS_IS + X11, "x11"), (GRANT + "The Software shall be used for Good, not Evil.\n" + AS_IS, "json"),
    (GRANT, ""), (GRANT + "Extra condition.\n" + AS_IS, ""), (GRANT + AS_IS.replace("TORT", "COURT"), ""),
    ("".join(BSD[k] for k in (0, 1, 2, 5)), "bsd-2-clause"), ("".join(BSD[k] for k in (0, 1, 2, 4, 5)), "bsd-3-clause"),
    (BSD[0] + BSD[1] + BSD[2] + "3. " + BSD[4] + BSD[5], "bsd-3-clause"), ("".join(BSD[:4]) + "4. " + BSD[4] + BSD[5], "bsd-4-clause"),
    ("".join(BSD[:3]), ""), ("".join(BSD[k] for k in (0, 1, 5)), ""),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
     "http://mozilla.org/MPL/2.0/.", "mpl-2.0"),
    ("This is free and unencumbered software released into the public domain.", ""),
])
def test_complete_texts(text, expected):
    got = L.Matcher().match("Some file.\n" + text + "\nmore words")
    assert got[5] == expected
    assert got[6] > 0.9 if expected and len(text) > 800 else True


def test_every_complete_text_has_its_own_label():
    for label, template in L.TEMPLATES:
        plain = re.sub(r"<<var;min=(\d+).*?>>", lambda m: "filler " * max(1, int(m[1])), template)
        plain = re.sub(r"<<.*?>>", " ", plain)
        assert label in labels(plain), label
