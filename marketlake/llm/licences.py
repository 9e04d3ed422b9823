"""License scans: templates with optional and replaceable regions, compiled into token automata.

Markup: ``<<optional>> ... <</optional>>`` may be left out, ``<<var n>>`` stands for one to n words of any
kind, all other words are mandatory. A text holds a license if the automaton accepts consecutive words
of it: then all mandatory wording matches exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import WORD_TABLE, table_batches, utf8

#: Phrases that are always looked for, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Wording of common notices and whole licenses as templates, by label of the method. Clause numbers
#: and links are optional, names of holders replaceable, all other words mandatory.
TEMPLATES = {
    "mit-notice": "released under <<optional>>the terms of<</optional>> <<optional>>the<</optional>> mit license",
    "mit-text": """
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the
        rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
        persons to whom the software is furnished to do so subject to the following conditions
        the above copyright notice and this permission notice <<optional>>including the next paragraph<</optional>>
        shall be included in all copies or substantial portions of the software
        the software is provided as is without warranty of any kind express or implied including but not limited to the
        warranties of merchantability fitness for a particular purpose and noninfringement in no event shall <<var 8>>
        be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising
        from out of or in connection with the software or the use or other dealings in the software""",
    "apache-2.0": "licensed under the apache license version 2 0 <<optional>>the license<</optional>>",
    "apache-2.0-header": """
        licensed under the apache license version 2 0 the license you may not use this file except in compliance with
        the license you may obtain a copy of the license at
        <<optional>>http<</optional>> <<optional>>https<</optional>> <<optional>>www<</optional>> apache org licenses license
        2 0 <<optional>>txt<</optional>> <<optional>>html<</optional>>
        unless required by applicable law or agreed to in writing software distributed under the license is distributed
        on an as is basis without warranties or conditions of any kind either express or implied
        see the license for the specific language governing permissions and limitations under the license""",
    "gpl-notice": "licensed under the <<optional>>terms of the<</optional>> gnu <<optional>>lesser<</optional>>"
    " general public license <<optional>>as published by the <<var 3>> foundation either<</optional>> version <<var 1>>",
    **{
        f"{label}-header": f"""
        is free software you can redistribute it and or modify it under the terms of the gnu {kind} general public license
        as published by the free software foundation <<optional>>either<</optional>> version <<var 2>> of the license
        <<optional>>or <<optional>>at your option<</optional>> any later version<</optional>>
        <<var 4>> is distributed in the hope that it will be useful but without any warranty without even the implied
        warranty of merchantability or fitness for a particular purpose see the gnu {kind} general public license for more
        details"""
        for label, kind in {"gpl": "", "lgpl": "lesser", "agpl": "affero"}.items()
    },
    **{
        label: f"""
        redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met
        <<optional>><<var 1>><</optional>> redistributions of source code must retain the above copyright notice this list of
        conditions and the following disclaimer
        <<optional>><<var 1>><</optional>> redistributions in binary form must reproduce the above copyright notice this list
        of conditions and the following disclaimer in the documentation and or other materials provided with the
        distribution {clause}
        this software is provided by <<var 12>> as is and any express or implied warranties including but not limited to
        the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall
        <<var 12>> be liable for any direct indirect incidental special exemplary or consequential damages including but not
        limited to procurement of substitute goods or services loss of use data or profits or business interruption
        however caused and on any theory of liability whether in contract strict liability or tort including negligence
        or otherwise arising in any way out of the use of this software even if advised of the possibility of such
        damage"""
        for label, clause in {
            "bsd-2-text": "",
            "bsd-3-text": """
        <<optional>><<var 1>><</optional>> neither the name of <<var 12>> nor the names of <<var 1>> contributors may be used to
        endorse or promote products derived from this software without specific prior written permission""",
        }.items()
    },
    "isc-text": """
        permission to use copy modify and <<optional>>or<</optional>> distribute this software for any purpose with or without
        fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
        the software is provided as is and <<var 8>> disclaims all warranties with regard to this software including all
        implied warranties of merchantability and fitness in no event shall <<var 8>> be liable for any special direct
        indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether
        in an action of contract negligence or other tortious action arising out of or in connection with the use or
        performance of this software""",
    "mpl-2.0-header": """
        this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not
        distributed with this file you can obtain one at <<optional>>http<</optional>> <<optional>>https<</optional>>
        <<optional>>www<</optional>> mozilla org mpl 2 0""",
    "cc-notice": "licensed under <<optional>>the<</optional>> <<optional>>creative commons<</optional>> cc by"
    " <<optional>>nc<</optional>> <<optional>>sa<</optional>> <<optional>>nd<</optional>> <<var 1>> <<optional>>0<</optional>>",
}

_TOKEN = re.compile(r"<<(optional|/optional|var \d+)>>|([^\x00-\x2f\x3a-\x60\x7b-\x7f<>]+)")


def parse(template: str) -> list:
    """Nested list of words (str), replaceable regions (int) and optional regions (list)."""
    stack: list[list] = [[]]
    for mark, word in _TOKEN.findall(template.lower()):
        if word:
            stack[-1].append(word)
        elif mark == "optional":
            stack.append([])
        elif mark == "/optional":
            region = stack.pop()
            stack[-1].append(region)
        else:
            stack[-1].append(int(mark.split()[1]))
    if len(stack) != 1:
        raise ValueError("optional region is not closed")
    return stack[0]


@dataclass
class Automaton:
    """Token automaton: for each state the word it reads (None: any word) and where it goes; -1 accepts."""

    start: frozenset[int]
    reads: list[tuple[bytes | None, frozenset[int]]]
    needed: frozenset[bytes]

    def end(self, words: list[bytes], at: int) -> int | None:
        """End of the longest run of words from ``at`` that is accepted."""
        states, found = self.start, None
        while True:
            if -1 in states:
                found = at
            if at == len(words) or not states:
                return found
            following: set[int] = set()
            for s in states:
                if s >= 0 and self.reads[s][0] in (None, words[at]):
                    following |= self.reads[s][1]
            states, at = following, at + 1


def compile_template(template: str) -> Automaton:
    reads: list[tuple[bytes | None, frozenset[int]]] = []

    def build(items: list, goal: frozenset[int]) -> frozenset[int]:
        """States from which the items, then the goal, are read; built from the end."""
        for item in reversed(items):
            if isinstance(item, list):
                goal = goal | build(item, goal)
            elif isinstance(item, int):
                after = goal
                for _ in range(item):
                    reads.append((None, after))
                    after = goal | {len(reads) - 1}
                goal = frozenset({len(reads) - 1})
            else:
                reads.append((item.encode(), goal))
                goal = frozenset({len(reads) - 1})
        return goal

    items = parse(template)
    start = build(items, frozenset({-1}))
    return Automaton(start, reads, frozenset(w.encode() for w in items if isinstance(w, str)))


def pattern(template: str) -> str:
    """The template as a regular expression over words with a blank behind each; for checks."""

    def build(items: list) -> str:
        return "".join(
            f"(?:{build(i)})?" if isinstance(i, list) else f"(?:[^ ]+ ){{1,{i}}}" if isinstance(i, int) else f"{i} " for i in items
        )

    return build(parse(template))


class Scanner:
    def __init__(self, templates: dict[str, str], base: dict[str, str]):
        self.automata = {label: compile_template(t) for label, t in templates.items()}
        self.base = {tuple(p.encode().split()): label for p, label in base.items()}

    def scan(self, text: bytes) -> tuple:
        """(n_words, base places, base labels, template spans by label)."""
        words = text.translate(WORD_TABLE).split()
        places, labels, spans = [], set(), {}
        have: set[bytes] | None = None
        # most texts hold none of the wording: one look at the bytes tells
        plain = text.lower()
        for phrase, label in self.base.items():
            if all(w in plain for w in phrase):
                first = phrase[0]
                at = -1
                while True:
                    try:
                        at = words.index(first, at + 1)
                    except ValueError:
                        break
                    if tuple(words[at : at + len(phrase)]) == phrase:
                        places.append(at)
                        labels.add(label)
        for label, automaton in self.automata.items():
            if not all(w in plain for w in automaton.needed):
                continue
            have = set(words) if have is None else have
            if not automaton.needed <= have:
                continue
            begins = {automaton.reads[s][0] for s in automaton.start if s >= 0}
            for at, word in enumerate(words):
                if None in begins or word in begins:
                    end = automaton.end(words, at)
                    if end is not None:
                        spans.setdefault(label, []).append((at, end))
        return len(words), places, labels, spans


def _scanned(templates: dict[str, str], base: dict[str, str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, base)
        for batch in table_batches(batches):
            rows = []
            for text in utf8(batch.column("text")):
                n, places, labels, spans = scanner.scan(text)
                every = [{"label": k, "first_word": a, "end_word": b} for k, v in sorted(spans.items()) for a, b in v]
                score = 1.0 if spans else 0.5 if places else 0.0
                rows.append(
                    (n, len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | set(spans))), score, every)
                )
            span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())])
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], ["id", *names]
            )

    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, base: dict[str, str] | None = None) -> DataFrame:
    """One row per row of ``docs``: (id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans).

    score is 1 if a template is accepted, 0.5 if only a base phrase is found, else 0; spans are the
    accepted runs of words, the longest from each place where one starts, so that spans may overlap. Null and empty texts have no words. Repeated rows and ids keep a row each;
    an empty table gives no rows.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(picked.dtypes)["id"]
    layout = (
        f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
        " spans array<struct<label:string,first_word:long,end_word:long>>"
    )
    return picked.mapInArrow(_scanned(templates or TEMPLATES, base or BASE), layout).withColumnRenamed("id", id_col)
