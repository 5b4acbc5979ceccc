"""License scan: texts matched against license templates with markup.

A template is wording with markup: ``<<beginOptional>> ... <<endOptional>>`` may be
left out, ``<<var;min=..;max=..>>`` stands for any words (``min`` to ``max`` of
them), everything else is mandatory and must match word for word. A template is
compiled into an automaton over tokens: states are places between words, an
optional part adds an empty move past it, a replaceable part consumes any word up
to its bound. All automata share one map from the words a match can begin with, so
a text is run only from places where one of them stands; the set of live states is
carried along and the longest acceptance counts.

Licenses of moderate length are compiled whole, so a text with a changed, added or
missing condition isn't accepted; of the long ones (Apache, GNU, Mozilla) the notices
that go with them are. A match that lies inside a longer one (the MIT wording
in the X11 license) yields no label of its own.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all other
non-ASCII characters. Besides the templates there are three base phrases whose
places are counted. The score is the share of the text's words that lie in an
accepted template or base phrase.

Whole texts are read, each in its own row: no shuffle, and state sets are bounded
by the templates. Defined results: a null or empty text has no words, no labels
and score 0; repeated rows and null ids keep their rows; an empty table gives an
empty result; other columns aren't read."""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table

# --- fixed values: phrases, labels and license wording ----------------------
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# wording that several licenses share, word for word
GRANT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
    "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so ")
NOTICE = (
    "subject to the following conditions the above copyright notice and this permission notice "
    "<<beginOptional>>including the next paragraph<<endOptional>> shall be included in all copies or substantial portions of the software ")
AS_IS = (
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement in no event shall ")
LIABLE = (
    " be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or "
    "in connection with the software or the use or other dealings in the software")
BSD_OPEN = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "<<beginOptional>>1<<endOptional>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "<<beginOptional>>2<<endOptional>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution ")
BSD_CLOSE = (
    "this software is provided by <<var;min=2;max=10>> as is and any express or implied warranties including but not limited to "
    "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<var;min=2;max=10>> be liable for any "
    "direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services "
    "loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort "
    "including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage")
ISC_CLOSE = (
    "the software is provided as is and <<var;min=1;max=8>> disclaims all warranties with regard to this software including all implied warranties of "
    "merchantability and fitness in no event shall <<var;min=1;max=8>> be liable for any special direct indirect or consequential damages or any damages "
    "whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or "
    "in connection with the use or performance of this software")

TEMPLATES = (
    # short notices
    ("apache-2.0", "licensed under the apache license <<beginOptional>>version<<endOptional>> 2 0 "
                   "<<beginOptional>>the license you may not use this file except in compliance with the license "
                   "you may obtain a copy of the license at <<var;min=0;max=12>> unless required by applicable law or agreed to in writing "
                   "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind "
                   "either express or implied see the license for the specific language governing permissions and limitations under the license<<endOptional>>"),
    ("mit", "<<beginOptional>>this software is<<endOptional>> released under the <<beginOptional>>terms of the<<endOptional>> mit license"),
    ("mit", "licensed under the <<beginOptional>>terms of the<<endOptional>> mit license"),
    ("cc-by-nc-4.0", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by sa 4 0"),
    ("cc-by-4.0", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by 4 0"),
    ("cc-by-4.0", "licensed under <<beginOptional>>a<<endOptional>> creative commons attribution 4 0 international license"),
    ("gpl-3.0", "<<beginOptional>>this work is<<endOptional>> licensed under the gnu general public license <<beginOptional>>version<<endOptional>> 3 <<beginOptional>>or any later version<<endOptional>>"),
    ("gpl-2.0", "<<beginOptional>>this work is<<endOptional>> licensed under the gnu general public license <<beginOptional>>version<<endOptional>> 2 <<beginOptional>>or any later version<<endOptional>>"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed "
                "with this file you can obtain one at <<var;min=1;max=12>>"),
    ("copyright", "copyright <<beginOptional>>c<<endOptional>> <<var;min=1;max=12>> all rights reserved"),
    ("spdx", "spdx license identifier <<var;min=1;max=1>>"),
    # the notices that go with the longer licenses
    ("gpl-3.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
                         "as published by the free software foundation either version 3 of the license or <<beginOptional>>at your option<<endOptional>> any later version"),
    ("gpl-2.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
                         "as published by the free software foundation either version 2 of the license or <<beginOptional>>at your option<<endOptional>> any later version"),
    ("lgpl-2.1-or-later", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license "
                          "as published by the free software foundation either version 2 1 of the license or <<beginOptional>>at your option<<endOptional>> any later version"),
    ("lgpl-3.0-or-later", "this <<var;min=1;max=2>> is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license "
                          "as published by the free software foundation either version 3 of the license or <<beginOptional>>at your option<<endOptional>> any later version"),
    ("agpl-3.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license "
                          "as published by the free software foundation either version 3 of the license or <<beginOptional>>at your option<<endOptional>> any later version"),
    # complete texts
    ("mit", GRANT + NOTICE + AS_IS + "the authors or copyright holders" + LIABLE),
    ("mit-0", GRANT + AS_IS + "the authors or copyright holders" + LIABLE),
    ("json", GRANT + NOTICE + "the software shall be used for good not evil " + AS_IS + "the authors or copyright holders" + LIABLE),
    ("x11", GRANT + NOTICE + AS_IS + "<<var;min=2;max=6>>" + LIABLE + " except as contained in this notice the name of <<var;min=1;max=8>> shall not be used in "
            "advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization from <<var;min=1;max=8>>"),
    ("bsd-2-clause", BSD_OPEN + BSD_CLOSE),
    ("bsd-3-clause", BSD_OPEN + "<<beginOptional>>3<<endOptional>> neither the name of <<var;min=1;max=10>> nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission " + BSD_CLOSE),
    ("bsd-4-clause", BSD_OPEN + "<<beginOptional>>3<<endOptional>> all advertising materials mentioning features or use of this software must display the following "
                     "acknowledgement this product includes software developed by <<var;min=1;max=14>> <<beginOptional>>4<<endOptional>> neither the name of <<var;min=1;max=10>> "
                     "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission " + BSD_CLOSE),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies " + ISC_CLOSE),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted " + ISC_CLOSE),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from "
             "the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and "
             "redistribute it freely subject to the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote "
             "the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required "
             "2 altered source versions must be plainly marked as such and must not be misrepresented as being the original software "
             "3 this notice may not be removed or altered from any source distribution"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by "
                "this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to "
                "permit third parties to whom the software is furnished to do so all subject to the following the copyright notices in the software and this entire "
                "statement including the above license grant this restriction and the following disclaimer must be included in all copies of the software in whole or in "
                "part and all derivative works of the software unless such copies or derivative works are solely in the form of machine executable object code generated "
                "by a source language processor the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
                "of merchantability fitness for a particular purpose title and non infringement in no event shall the copyright holders or anyone distributing the software "
                "be liable for any damages or other liability whether in contract tort or otherwise arising from out of or in connection with the software or the use or "
                "other dealings in the software"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this "
                  "software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that "
                  "recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain we make "
                  "this dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of "
                  "relinquishment in perpetuity of all present and future rights to this software under copyright law " + AS_IS + "the authors" + LIABLE),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is "
              "changed do what the fuck you want to public license terms and conditions for copying distribution and modification 0 you just do what the fuck you want to"),
    ("cc0-1.0", "person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide "
                "under copyright law including all related and neighboring rights to the extent allowed by law you can copy modify distribute and perform the work even "
                "for commercial purposes all without asking permission"),
)
# ----------------------------------------------------------------------------

_MARKUP = re.compile(r"<<(beginOptional|endOptional|var(?:;\w+=\d+)*)>>|([^<\s]+)")
# separators become spaces, A-Z become a-z, other bytes stay
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


class Automaton:
    """states 0..accept; ``step``: state -> {word: state}, ``free``: state ->
    state by any word, ``empty``: state -> states without a word."""

    def __init__(self, template: str):
        self.step: list[dict[bytes, int]] = [{}]
        self.free: dict[int, int] = {}
        self.empty: dict[int, list[int]] = {}
        at, opened = 0, []
        for mark, word in _MARKUP.findall(template):
            if word:
                at = self._add(at, word.lower().encode())
            elif mark == "beginOptional":
                opened.append(at)
            elif mark == "endOptional":
                self.empty.setdefault(opened.pop(), []).append(at)
            else:
                bound = {"min": 0, "max": 8} | {k: int(v) for k, v in (p.split("=") for p in mark.split(";")[1:])}
                ways_out = []
                for used in range(bound["max"]):
                    if used >= bound["min"]:
                        ways_out.append(at)
                    nxt = self._add(at, None)
                    self.free[at] = nxt
                    at = nxt
                for s in ways_out:
                    self.empty.setdefault(s, []).append(at)
        if opened:
            raise ValueError("an optional part isn't closed")
        self.accept = at

    def _add(self, at: int, word: bytes | None) -> int:
        self.step.append({})
        if word is not None:
            self.step[at][word] = len(self.step) - 1
        return len(self.step) - 1

    def closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.empty.get(todo.pop(), ()):
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    def first_words(self) -> set[bytes]:
        start = self.closed({0})
        if self.accept in start or any(s in self.free for s in start):
            raise ValueError("a template must begin with a mandatory word")
        return {w for s in start for w in self.step[s]}

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest match that begins at word ``at``, or -1."""
        live, end = self.closed({0}), -1
        while live:
            if self.accept in live:
                end = at
            if at == len(words):
                break
            w = words[at]
            live = self.closed({n for s in live if (n := self.step[s].get(w, self.free.get(s))) is not None}
                               | {self.free[s] for s in live if s in self.free})
            at += 1
        return end


class Matcher:
    def __init__(self, templates=TEMPLATES, base=BASE):
        self.base = [(tuple(p.encode().split()), label) for p, label in base]
        self.automata = [(label, Automaton(t)) for label, t in templates]
        self.begins: dict[bytes, list[tuple[str, Automaton]]] = {}
        for label, a in self.automata:
            for w in a.first_words():
                self.begins.setdefault(w, []).append((label, a))
        self.by_first = {}
        for phrase, label in self.base:
            self.by_first.setdefault(phrase[0], []).append((phrase, label))
        # a text without any of these words can hold neither a base phrase nor a template
        self.needed = frozenset(self.begins) | frozenset(self.by_first)

    def match(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score."""
        words = words_of(text)
        if self.needed.isdisjoint(words):
            return len(words), 0, None, None, "", "", 0.0
        places, base, found, spans = [], set(), [], []
        for k, w in enumerate(words):
            if w not in self.needed:
                continue
            for phrase, label in self.by_first.get(w, ()):
                if tuple(words[k:k + len(phrase)]) == phrase:
                    places.append(k)
                    base.add(label)
                    spans.append((k, k + len(phrase)))
            for label, a in self.begins.get(w, ()):
                end = a.longest(words, k)
                if end > 0:
                    found.append((k, end, label))
                    spans.append((k, end))
        # wording that lies inside a longer match is part of that license, not one of its own
        labels = {label for a, b, label in found if not any(x <= a and b <= y and y - x > b - a for x, y, _ in found)}
        covered = at = 0
        for a, b in sorted(spans):
            covered += max(0, b - max(a, at))
            at = max(at, b)
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | labels)), covered / len(words) if words else 0.0)


@cache
def matcher() -> Matcher:
    return Matcher()


def scan_licenses(docs: DataFrame, templates=TEMPLATES, base=BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    def run(batches):
        m = Matcher(templates, base)
        for b in batches:
            rows = [m.match(t) for t in b.column(1).to_pylist()]
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                             ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
