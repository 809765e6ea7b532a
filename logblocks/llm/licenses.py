"""License scans by template-markup matching.

A template is license wording with markup: ``[[ ... ]]`` is optional, ``{{name:min-max}}`` is replaceable
by min to max words. ``compile_template`` turns it into a token automaton: a chain of mandatory
words with skips over optional regions and bounded loops for replaceable ones. A text is accepted
where a run of its words goes through the automaton: its mandatory wording matches exactly.

Words are the runs of ASCII letters and digits (A-Z lower-cased) and of characters beyond ASCII. Base
phrases are looked for as consecutive words; templates add labels of their own.

One pass over whole texts in Arrow batches, no shuffle. An automaton starts only at the
places of its first mandatory word, and only in texts that hold its rarest words.

A null text counts as empty: no words, no labels, score 0. Repeated rows get equal answers. Only the id
and text columns are read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.shipping import ship

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wording in markup, and the label it carries; notices, first sentences and whole license texts.
TEMPLATES = {
    "mit-notice": "[[this {{work:0-3}} is]] released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this {{work:1-8}} "
    "to deal in the software without restriction",
    "apache-2-notice": "licensed under the apache license version 2 0 [[the license]]",
    "gpl-3-notice": "[[this {{work:0-4}} is]] licensed under the gnu [[lesser]] general public license version 3 [[or later]]",
    "cc-by-nc-notice": "licensed under [[a]] [[creative commons]] cc by nc {{version:1-2}}",
    "cc-by-notice": "licensed under [[a]] creative commons attribution {{version:1-2}} [[international]] license",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met",
    "isc-text": "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee "
    "is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mit-license": "[[the]] [[mit license]] [[copyright {{holder:1-12}}]] permission is hereby granted free of charge to any person obtaining a copy "
    "of this software and associated documentation files the software to deal in the software without restriction including without "
    "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons "
    "to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice "
    "[[including the next paragraph]] shall be included in all copies or substantial portions of the software the software is provided as is "
    "without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular "
    "purpose and noninfringement in no event shall {{holder:1-8}} be liable for any claim damages or other liability whether in an action of "
    "contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "bsd-2-clause": "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
    "disclaimer in the documentation and or other materials provided with the distribution this software is provided by {{owner:1-10}} as is "
    "and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular "
    "purpose are disclaimed in no event shall {{owner:1-10}} be liable for any direct indirect incidental special exemplary or consequential "
    "damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in "
    "any way out of the use of this software even if advised of the possibility of such damage",
    "bsd-3-clause": "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
    "disclaimer in the documentation and or other materials provided with the distribution [[3]] neither the name of {{organization:1-12}} nor "
    "the names of its contributors may be used to endorse or promote products derived from this software without specific prior written "
    "permission this software is provided by {{owner:1-10}} as is and any express or implied warranties including but not limited to the "
    "implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{owner:1-10}} be liable for "
    "any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or "
    "services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict "
    "liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility "
    "of such damage",
    "isc": "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted provided "
    "that the above copyright notice and this permission notice appear in all copies the software is provided as is and {{author:1-6}} "
    "disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall "
    "{{author:1-6}} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use "
    "data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or "
    "performance of this software",
    "apache-2-header": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
    "license you may obtain a copy of the license at [[http]] [[https]] [[www apache org licenses license 2 0]] unless required by applicable "
    "law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of "
    "any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "copyright-notice": "copyright [[c]] {{year:1-1}} [[by]] {{holder:1-6}} all rights reserved",
}

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Automaton:
    """States 0..n; ``step[s]`` is a word to state n+1, ``skip[s]`` states reached for free.

    A replaceable region of min to max words is max states that take any word, the last
    max - min of which can be skipped.
    """

    def __init__(self, markup: str):
        self.step: list[bytes | None] = []  # None takes any word
        self.skip: dict[int, list[int]] = {}
        open_at: list[int] = []
        for token in re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", markup):
            if token == "[[":
                open_at.append(len(self.step))
            elif token == "]]":
                self.skip.setdefault(open_at.pop(), []).append(len(self.step))
            elif token.startswith("{{"):
                least, most = map(int, re.search(r"(\d+)-(\d+)", token).groups())
                start = len(self.step)
                self.step += [None] * most
                for k in range(least, most):
                    self.skip.setdefault(start + k, []).append(start + most)
            else:
                self.step.append(token.encode())
        self.final = len(self.step)
        starts = self._closure({0})
        self.first = {self.step[s] for s in starts if s < self.final}
        depth = 0
        mandatory = []
        for token in re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", markup):
            depth += (token == "[[") - (token == "]]")
            if depth == 0 and not token.startswith(("[[", "]]", "{{")):
                mandatory.append(token.encode())
        self.mandatory = set(mandatory)

    def _closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for after in self.skip.get(todo.pop(), ()):
                if after not in states:
                    states.add(after)
                    todo.append(after)
        return states

    def accept(self, text: list[bytes], start: int) -> int:
        """The longest end of a match that starts at word ``start``; -1 if there is none."""
        states, end, at = self._closure({0}), -1, start
        while True:
            if self.final in states:
                end = at
            if at >= len(text):
                return end
            word = text[at]
            states = {s + 1 for s in states if s < self.final and self.step[s] in (None, word)}
            if not states:
                return end
            states, at = self._closure(states), at + 1


def compile_templates(templates: dict[str, str]) -> dict[str, Automaton]:
    return {label: Automaton(markup) for label, markup in templates.items()}


class Scanner:
    def __init__(self, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES):
        self.base = [(p.encode().split(), label) for p, label in base.items()]
        self.automata = compile_templates(templates)

    def scan(self, text: str | None) -> dict:
        found = words(text)
        flat = b" " + b" ".join(found) + b" "
        hits, spans, labels = [], [], set()
        places: dict[bytes, list[int]] | None = None
        for phrase, label in self.base:
            if b" " + b" ".join(phrase) + b" " not in flat:
                continue
            here = [k for k in range(len(found) - len(phrase) + 1) if found[k] == phrase[0] and found[k : k + len(phrase)] == phrase]
            hits += [(k, label) for k in here]
            spans += [(k, k + len(phrase)) for k in here]
        base = {label for _, label in hits}
        for label, automaton in self.automata.items():
            if any(b" " + w + b" " not in flat for w in automaton.mandatory):
                continue
            if places is None:
                places = {}
                for k, word in enumerate(found):
                    places.setdefault(word, []).append(k)
            anywhere = None in automaton.first
            for start in range(len(found)) if anywhere else sorted(k for w in automaton.first for k in places.get(w, ())):
                end = automaton.accept(found, start)
                if end > start:
                    labels.add(label)
                    spans.append((start, end))
        covered, reach = 0, 0
        for a, b in sorted(spans):
            covered += max(0, b - max(a, reach))
            reach = max(reach, b)
        starts = [k for k, _ in hits]
        return {
            "n_words": len(found),
            "n_base": len(hits),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | labels)),
            "score": covered / len(found) if found else 0.0,
            "spans": sorted(spans),
        }


COLUMNS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def license_scan(docs: DataFrame, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per document; score is the share of its words that lie in license wording."""
    ship(docs.sparkSession)
    kinds = {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}
    names = [c.split()[0] for c in COLUMNS.split(", ")][1:]

    def body(batches):
        scanner = Scanner(base, templates)
        for batch in batches:
            found = [scanner.scan(t) for t in batch.column("text").to_pylist()]
            columns = {n: pa.array([f[n] for f in found], kinds.get(n, pa.int64())) for n in names}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **columns})

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return named.mapInArrow(body, COLUMNS)

