"""Scans texts for licence notices and identifier tags.

An Aho-Corasick automaton over words finds notice phrases and the
identifier tag; its goto and failure links cover every phrase in one pass,
and words outside the phrases' vocabulary reset it without a step.  The
expression behind a tag is parsed by a shunting yard (WITH binds closer
than AND, AND closer than OR) and evaluated to its licences and to how
restrictive their combination is.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame

from stratus.llm.license_names import GNU_FAMILIES, VERSION_ENDINGS, exceptions, titles
from stratus.llm.words import slices

# The contract's base phrases and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notice phrases and labels of this scanner
NOTICES = {
    "mit license": "mit",
    "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "mozilla public license version 2 0": "mpl-2.0",
    "gnu lesser general public license": "lgpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "affero general public license": "agpl",
    "cc by 4 0": "cc-by-4.0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
}
TAG = "spdx license identifier"
# How restrictive a label is: the first prefix that fits counts, any other licence OTHER
LEVELS = [
    ("reserved", 1.0), ("cc-by-nc", 0.9), ("cc-by-nd", 0.9), ("busl", 0.9), ("sspl", 0.9), ("agpl", 0.8), ("lgpl", 0.5),
    ("gpl", 0.7), ("cc-by-sa", 0.6), ("odbl", 0.6), ("osl", 0.6), ("eupl", 0.6), ("mpl", 0.4), ("epl", 0.4), ("cddl", 0.4),
    ("cc-by", 0.2), ("ofl", 0.2), ("apache", 0.1), ("bsd", 0.1), ("bsl", 0.1), ("mit", 0.1), ("isc", 0.1), ("zlib", 0.1),
    ("x11", 0.1), ("ncsa", 0.1), ("postgresql", 0.1), ("psf", 0.1), ("upl", 0.1), ("0bsd", 0.0), ("cc0", 0.0), ("pddl", 0.0),
    ("public-domain", 0.0), ("unlicense", 0.0), ("wtfpl", 0.0),
]
OTHER = 0.5
BROKEN = "broken-expression"
# In front of an identifier that the list of licences does not hold
UNKNOWN = "unknown:"
_TITLES, _EXCEPTIONS = titles(), exceptions()

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TAG = re.compile(r"spdx-license-identifier:[ \t]*([^\n\r]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_BINDS = {"OR": 1, "AND": 2, "WITH": 3}


def words_of(text: bytes) -> list[bytes]:
    """``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.translate(_FOLD).split()


class Automaton:
    """Aho-Corasick over words: ``places`` yields (first word, phrase) for every place of every phrase."""

    def __init__(self, phrases: Mapping[str, object]):
        self.go: list[dict[bytes, int]] = [{}]
        self.ends: list[list[tuple[int, str]]] = [[]]
        for phrase in phrases:
            words, state = phrase.encode().split(), 0
            for w in words:
                nxt = self.go[state].get(w)
                if nxt is None:
                    nxt = len(self.go)
                    self.go[state][w] = nxt
                    self.go.append({})
                    self.ends.append([])
                state = nxt
            self.ends[state].append((len(words), phrase))
        self.fail = [0] * len(self.go)
        todo = deque(self.go[0].values())
        while todo:
            state = todo.popleft()
            for w, nxt in self.go[state].items():
                f = self.fail[state]
                while f and w not in self.go[f]:
                    f = self.fail[f]
                self.fail[nxt] = self.go[f].get(w, 0)
                self.ends[nxt] = self.ends[nxt] + self.ends[self.fail[nxt]]
                todo.append(nxt)
        self.vocabulary = {w for g in self.go for w in g}

    def places(self, words: list[bytes]) -> Iterator[tuple[int, str]]:
        vocabulary, go, fail, ends = self.vocabulary, self.go, self.fail, self.ends
        state, last = 0, -2
        for i in [i for i, w in enumerate(words) if w in vocabulary]:
            if i != last + 1:
                state = 0
            last, w = i, words[i]
            while state and w not in go[state]:
                state = fail[state]
            state = go[state].get(w, 0)
            for n, phrase in ends[state]:
                yield i - n + 1, phrase


def known(identifier: str) -> bool:
    """Whether an identifier is in the list, names a version of a GNU licence in it, or is a reference of the text's own."""
    name = identifier.lower()
    if name.startswith(("licenseref-", "documentref-")):
        return True
    if name.startswith(GNU_FAMILIES):
        name = next((name.removesuffix(e) for e in VERSION_ENDINGS if name.endswith(e)), name)
    return name.removesuffix("+") in _TITLES


def phrases() -> dict[str, str]:
    """Notice phrases and their labels: this scanner's own, and the titles of the list (two words or more)."""
    found = {}
    for name, title in _TITLES.items():
        phrase = b" ".join(words_of(title.encode())).decode()
        if " " in phrase and phrase not in BASE:
            found.setdefault(phrase, name)
    return found | NOTICES


def level_of(licence: str) -> float:
    """How restrictive a label of this scanner or a known licence is."""
    name = licence.lower()
    return next((x for prefix, x in LEVELS if name.startswith(prefix)), OTHER)


def evaluate(expression: str) -> tuple[set[str], float]:
    """The licences of a tag's expression (lower case) and how restrictive it is.

    ``a AND b`` is as restrictive as the worse, ``a OR b`` as the better; a
    known exception (``a WITH e``) halves its licence.  An identifier that is
    not in the list is labelled ``unknown:`` and its name, and counts as
    OTHER.  A malformed expression has the licences it names, the label
    ``broken-expression`` and the worst level among them (OTHER if it names
    none).
    """
    out: list[tuple] = []
    ops: list[str] = []
    named: set[str] = set()
    worst: list[float] = []

    def reduce() -> None:
        op = ops.pop()
        if op == "(":
            raise ValueError("unbalanced")
        b, a = out.pop(), out.pop()
        if op == "WITH":
            if b[0] != "exception":
                raise ValueError("no exception")
            out.append(("licence", a[1] / 2 if b[1] else a[1]))
        else:
            out.append(("licence", max(a[1], b[1]) if op == "AND" else min(a[1], b[1])))

    after_value = False
    try:
        for tok in _TOKEN.findall(expression):
            up = tok.upper()
            if up in _BINDS:
                if not after_value:
                    raise ValueError("operator without a left side")
                while ops and ops[-1] != "(" and _BINDS[ops[-1]] >= _BINDS[up]:
                    reduce()
                ops.append(up)
                after_value = False
            elif tok == "(":
                if after_value:
                    raise ValueError("two values")
                ops.append(tok)
            elif tok == ")":
                if not after_value:
                    raise ValueError("empty group")
                while ops and ops[-1] != "(":
                    reduce()
                if not ops:
                    raise ValueError("unbalanced")
                ops.pop()
            else:
                if after_value:
                    raise ValueError("two values")
                name = tok.lower()
                if ops and ops[-1] == "WITH":
                    in_list = name in _EXCEPTIONS
                    named |= set() if in_list else {UNKNOWN + name}
                    out.append(("exception", in_list))
                else:
                    in_list = known(name)
                    level = level_of(name) if in_list else OTHER
                    named.add(name if in_list else UNKNOWN + name)
                    worst.append(level)
                    out.append(("licence", level))
                after_value = True
        if not after_value:
            raise ValueError("ends early")
        while ops:
            reduce()
        if len(out) != 1:
            raise ValueError("values left")
        return named, out[0][1]
    except (ValueError, IndexError):
        return named | {BROKEN}, max(worst, default=OTHER)


def scan_text(text: bytes, automaton: Automaton, notices: Mapping[str, str] = NOTICES) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    words = words_of(text)
    base, found, score, first, last, n = set(), set(), 0.0, None, None, 0
    tagged = False
    for at, phrase in automaton.places(words):
        if phrase == TAG:
            tagged = True
            continue
        label = BASE.get(phrase)
        if label:
            n += 1
            first = at if first is None else min(first, at)
            last = at if last is None else max(last, at)
            base.add(label)
        else:
            label = notices[phrase]
        found.add(label)
        score = max(score, level_of(label))
    if tagged:
        for m in _TAG.finditer(text.decode("utf-8", "replace")):
            named, level = evaluate(m[1])
            found |= named
            score = max(score, level)
    return len(words), n, first, last, ",".join(sorted(base)), ",".join(sorted(found)), score


_OUT = pa.struct(
    [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the scan of its whole text, one row per row of ``docs``.

    n_words; n_base, first_word, last_word (places of the base phrases:
    how many, smallest and largest first word, null without any);
    base_labels and labels (distinct, sorted, comma-joined; empty string
    without any); score (0: no or free notice, 1: all rights reserved; the
    most restrictive finding counts).  A null text counts as empty.  Other
    columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notices = phrases()
        automaton = Automaton({**BASE, **notices, TAG: None})
        for b in slices(batches):
            rows = [scan_text(t or b"", automaton, notices) for t in b.column(1).cast(pa.binary()).to_pylist()]
            out = [pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)]
            yield pa.RecordBatch.from_arrays([b.column(0), *out], [id_col, *(f.name for f in _OUT)])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run,
        f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )
