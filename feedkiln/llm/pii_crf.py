"""Personal data: a linear-chain conditional random field over word shapes.

Base spans follow fixed patterns (e-mail, IP address, payment card, phone) and
always stand. The field adds spans that the patterns miss: numbers and addresses
in other notations and names after an introduction. Its features are word
shapes (letter case, digits, punctuation), lengths, affixes and a few cue words,
of the word and its neighbours. It is trained in numpy from the small labelled
table below by gradient ascent on the conditional likelihood (forward-backward).

A text is one sequence of all its words, decoded by Viterbi. Features come from
word signatures, so a word costs one look-up; emissions are gathered in blocks. A
word is skipped only where the weights prove that it is outside on every best path:
no run of words around it can gain by leaving the outside state (``stretches``). The
stretches between proved words are decoded exactly, in batches of equal length.

Defined results: a null or empty text has no spans, an empty table gives no rows;
repeated rows give equal results; a very long text is one sequence, whose words take
a few numbers each; a span of the field that overlaps a base span is dropped; a base
match that fails its check (IP parts, card length and Luhn digit, phone digits) is
dropped without a second try; of paths that tie the one with the lower state numbers
is taken; positions are code points, the end exclusive; columns other than the id and
the text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from feedkiln.llm.common import fields, slices

KINDS = ("email", "ip", "card", "phone")
#: Kinds that the field may add.
ADDED = ("email", "ip", "card", "phone", "name")
STATES = ["O"] + [f"{p}-{k}" for k in ADDED for p in "BI"]
#: Neighbours whose features count, as offsets from the word; of the farthest one only cues.
OFFSETS = (-2, -1, 0, 1)
FAR = -2
PAD = max(map(abs, OFFSETS))
#: Words whose emissions are laid out at once, and characters whose words are listed at once.
BLOCK_WORDS, BLOCK_CHARS = 1 << 16, 1 << 18

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: the local part is the run of its
    characters before it, from the end of the last match at the earliest."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.fullmatch(text, start - 1, start):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        # a run without a match cannot begin a later one before this @
        done = max(done, at + 1) if not m else done
        at = text.find("@", max(done, at + 1))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", s, e) for s, e in emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(g.lstrip("0")) < 4 and int(g) < 256 for g in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# fixed values: the labelled table. Words stand as word/state, unmarked words outside.
LABELLED = """
mail jane(at)example.org/B-email today
send it to j.doe[at]mail.example.net/B-email please
contact bob_at_example_dot_com/B-email for more
reach me at info(at)firm.example/B-email or later
the host 192-168-10-12/B-ip answered slowly
server 10-0-0-7/B-ip is down again
ping 172:16:254:1/B-ip from there
address fe80::1ff:fe23:4567:890a/B-ip was seen
log in from 2001:db8::8a2e:370:7334/B-ip at noon
card 4111/B-card 1111/I-card 1111/I-card 1234/I-card was used
pay with 5500.0000.0000.0004/B-card now
visa 4012/B-card 8888/I-card 8888/I-card 1881/I-card expires soon
number 3782/B-card 822463/I-card 10005/I-card on the card
call (017)/B-phone 555-7713/I-phone after six
call 555-123-4567/B-phone for help
phone 017/B-phone 555/I-phone 7713/I-phone today
tel 030/B-phone 1234567/I-phone bitte
fax (030)/B-phone 123-4567/I-phone oder schreiben
ring 0044-20-7946-0018/B-phone before noon
tel. 020/B-phone 7946/I-phone 0018/I-phone or write
a man named Anna/B-name Berg/I-name agreed
she is named Maria/B-name Lopez/I-name now
dear Mr. John/B-name Smith/I-name thank you
signed by Dr. Paul/B-name Weber/I-name yesterday
ask Mrs. Helen/B-name Clark/I-name about it
please ask Ms. Laura/B-name Stone/I-name about it
then Miss Emma/B-name Wood/I-name agreed with us
Ms. Carol/B-name Hunt/I-name wrote to us
my name is Robert/B-name Hall/I-name and I agree
My name is Linda/B-name King/I-name from here
Herr Karl/B-name Maier/I-name hat es gesagt
Frau Eva/B-name Schulz/I-name ist da
Madame Claire/B-name Dubois/I-name est ici
contact John/B-name Miller/I-name for details
in 1999 the price was 300 and rose
page 12 of 340 was missing
it rose by 3.5 percent in 2011
section 4.2.1 tells more about that
version 2.10.3 came out in May
at 10:30 on the 5th of June
about 1,200,000 people live there
room 101 was empty at 9
call me later or write a note
the card was lost and the phone too
named places and the time
dear friends and all who came
the name is short and that is all
it is The end of that
his name and the date at the top
see item 12345 in the list
order 20231145 was shipped on 2023-11-05
id 9f8e7d6c5b4a3210 was not found
hash 4b825dc642cb6eb9a060e54bf8d69288 of the file
score 12-10 and 14-12 in the end
from 8-10 until 12-14 each day
code 1234567890123456 was refused
a number like 1111222233334444 means nothing
the ratio 3:1 or 16:9 is common
array [1 2 3] and (4 5 6) follow
chapter 7 verses 12 to 14
we counted 17 18 and 19 of them
row 1 2 3 4 5 6 7 8 of it
12 345 67 8 90 123 45 6
2001 2002 2003 2004 2005 2006 were good years
under the Public License, Version 2.0. Some more
a General License, version 2 or later
it has 10.20.30.40 after it. Then more goes on
at 10.20.30.40 there. Then One came
of 1234123412341234 more. Other And More follow
in 12 cases. The Next Part begins
password=00ff11ee22dd33cc44 was set
key=0123456789abcdef01 and token 1a2b3c4d
It Was here. As Before 5 times
call Later Today or Tomorrow
contact The office at 9
|| 10.20.30.40 | more | Cells | here |
"0000a0ab0c0d0e0f00a00000b00b0bc000e0000" stands here
We went to the Old Town. There we saw the River House and left.
The River is long. Many People live there, and They like it.
Das Haus steht am Fluss. Der Mann und die Frau gehen in den Wald.
Am Morgen kam der Zug aus Norden, und die Leute stiegen ein.
Le Chat est noir. La Maison est grande, et les Enfants jouent.
El Perro corre por la Calle. La Casa es grande y blanca.
these&&& are### words*** with$$$ odd%%% Signs~~~ after### Them&&& and&&& more*** of.%%% them,###
"Quoted Words" (and Others) stand here; _So_ do these -- and 'Those' too...
item/part a+b c=d x<y #Tag ~line ^up 50% of $20 or 3rd and 4th [note] {id} a|b \\n end.
As the Day went on And on, No One came To the Door. It was Late, Yet They stayed.
as as as as is is is is the the the the more more more more Word Word Word Word
name name is is dear dear contact contact call call card card host host named named
visa or card or number or phone or fax or mail or server are words like others
Über den Äckern war es still. Él no quiso. École et été. Ñandú y niño.
word and more words that go on and on without any end at all
* First point: see below; Second Point: see above!
<p> some text </p> <b> Bold Text </b> {x} = [y]
"""

# fixed values: words that serve as features by themselves
CUES = ("call phone tel tel. fax ring contact mail email e-mail write card visa number pay host server ip ping "
        "named dear mr mr. mrs mrs. ms ms. miss dr dr. herr frau madame monsieur signed reach name is").split()
_CUE = frozenset(CUES)
_WORD = re.compile(r"(?<![^\s])(?:" + "|".join(f"[{c[0]}{c[0].upper()}]{re.escape(c[1:])}" for c in sorted(CUES, reverse=True)) + r")(?=\s)")
_WORD = re.compile(r"\S+")
_SPACE = re.compile(r"\s")
_DIGIT = re.compile(r"\d")
_RUN = re.compile(r"([A-Z])[A-Z]*|([a-z])[a-z]*|([0-9])|([^\x00-\x7F])[^\x00-\x7F]*", re.DOTALL)


def shape(word: str) -> str:
    """Letter runs as ``A`` or ``a``, every digit as ``9`` up to 20 characters, the rest as it is."""
    if word.isascii() and word.isalpha():  # the same for plain words
        if word.islower():
            return "a"
        if word.istitle():
            return "Aa" if len(word) > 1 else "A"
    return _RUN.sub(lambda m: "A" if m[1] else "a" if m[2] else "9" if m[3] else "u", word[:64])[:20]


def signature(word: str) -> tuple[str, int, int, str]:
    """All that the features of a word are made of: shape, digits, length, cue."""
    low = word[:40].lower()
    core = low.strip(".,;:!?\"'")
    digits = 0 if word.isalpha() else min(len(_DIGIT.findall(word, 0, 64)), 20)
    return shape(word), digits, min(len(word), 20), core.rstrip(".") if core in _CUE or low in _CUE else ""


def features_of(word: str) -> list[str]:
    """Features of a word by itself; neighbours' are added with their offset."""
    s, digits, size, cue = signature(word)
    out = [f"s={s}", f"d={digits}", f"l={size}", f"p={''.join(sorted({c for c in s if not c.isalnum()}))}", f"f={s[:1]}{s[-1:]}", "any"]
    return [*out, f"c={cue}"] if cue else out


class Field:
    """Weights of the features per state, and of the state transitions."""

    def __init__(self, epochs: int = 120, rate: float = 0.5, decay: float = 2e-3):
        rows = []
        for line in LABELLED.strip().splitlines():
            words, states = [], []
            for item in line.split(" "):
                word, _, state = item.rpartition("/")
                known = state in STATES and state != "O"
                words.append(word if known or state == "O" and word else item)
                states.append(STATES.index(state) if known else 0)
            rows.append((words, states))
        self.index: dict[str, int] = {}
        coded = [([self.code(w, learn=True) for w in words], states) for words, states in rows]
        k = len(STATES)
        self.emit, self.move = np.zeros((len(self.index), k)), np.zeros((k + 1, k))  # the last row of move starts a sequence
        step = [np.full_like(self.emit, 1e-8), np.full_like(self.move, 1e-8)]
        # an inside state follows only its own beginning or inside
        self.legal = np.array([[t[0] != "I" or (f != "O" and f[2:] == t[2:]) for t in STATES] for f in [*STATES, "O"]])
        table = _Table([self.around(words) for words, _ in coded], [states for _, states in coded], k)
        for _ in range(epochs):
            g = table.gradient(self.emit, self.transitions())
            for p, grad, s in zip((self.emit, self.move), g, step, strict=True):
                grad -= decay * p
                s += grad * grad
                p += rate * grad / np.sqrt(s)
        self.fit_tables()

    def code(self, word: str, learn: bool = False) -> list[int]:
        """Numbers of the features of a word, each as seen at every offset; -1 if the table has it not."""
        out = []
        for f in features_of(word):
            for o in OFFSETS:
                key = f"{o}{f}"
                if learn and (o != FAR or f.startswith("c=")):
                    self.index.setdefault(key, len(self.index))
                out.append(self.index.get(key, -1))
        return out

    @staticmethod
    def around(words: list[list[int]]) -> list[list[int]]:
        """Per position: features of the word and of its neighbours."""
        n = len(words)
        return [[f for j, o in enumerate(OFFSETS) if 0 <= i + o < n for f in words[i + o][j::len(OFFSETS)] if f >= 0] for i in range(n)]

    def transitions(self) -> np.ndarray:
        return np.where(self.legal, self.move, -1e9)

    def fit_tables(self) -> None:
        """What decoding needs of the trained weights: rows of emissions by word
        signature (row 0: no word there), and the bounds of ``stretches``."""
        self.rows: dict[tuple[int, ...], int] = {(): 0}
        self.kinds: dict[tuple, int] = {}
        self.table = np.zeros((1, len(OFFSETS), len(STATES)))
        self.words = _Numbers(self)
        move, k = self.transitions(), len(STATES)
        stay = move[0, 0]
        self.go_on = (move[1:k, 1:] - stay).max()
        enter = max((move[0, 1:] - stay).max(), (move[k, 1:] - move[k, 0]).max())
        self.there_and_back = enter + max((move[1:k, 0] - stay).max(), 0.0)

    def row(self, word: str) -> int:
        """The row of a word's known features. Their number is bounded by the
        labelled table, however many words and signatures there are."""
        kind = signature(word)
        got = self.kinds.get(kind)
        if got is None:
            code = tuple(self.code(word))
            got = self.kinds[kind] = self.rows.setdefault(code, len(self.rows))
            if got >= len(self.table):
                self.table = np.concatenate([self.table, np.zeros((len(self.table) + 16, *self.table.shape[1:]))])
            for j in range(len(OFFSETS)):
                self.table[got, j] = self.emit[[f for f in code[j::len(OFFSETS)] if f >= 0]].sum(axis=0)
        return got

    def numbers(self, words: list[str]) -> np.ndarray:
        """Signature rows of words."""
        if max(len(self.words), len(self.kinds)) > 300_000:
            self.words.clear()
            self.kinds.clear()
        return np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))

    def emissions(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores of every state at the places ``at`` of laid out sequences."""
        return sum(self.table[flat[at + o], j] for j, o in enumerate(OFFSETS))

    def margins(self, flat: np.ndarray) -> np.ndarray:
        """What a marked position gains over outside at most, the move to the next one included."""
        out = np.empty(len(flat) - 2 * PAD)
        for lo in range(0, len(out), BLOCK_WORDS):
            e = self.emissions(flat, np.arange(lo + PAD, min(len(out), lo + BLOCK_WORDS) + PAD))
            out[lo: lo + BLOCK_WORDS] = e[:, 1:].max(axis=1) - e[:, 0] + self.go_on
        return out

    def stretches(self, margins: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of positions of one sequence that a best path may mark; all
        others are outside on every best path. A marked run gains at most the sum
        of its positions' margins and of the moves there and back, so a position
        is out if no run around it reaches 0: the greatest sum of a run around
        a position is the greatest prefix sum from it on, less the least before it."""
        if not len(margins):
            return []
        total = np.concatenate([[0.0], np.cumsum(margins)])
        best = np.maximum.accumulate(total[:0:-1])[::-1] - np.minimum.accumulate(total[:-1])
        may = np.concatenate([[False], best + (self.there_and_back - self.go_on) >= -1e-6, [False]])
        edge = np.flatnonzero(may[1:] != may[:-1])
        return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))

    def marked(self, sequences: list[np.ndarray]) -> list[tuple[int, int, np.ndarray]]:
        """(sequence, first place, best states) of the stretches of all sequences
        of signature rows, every other place being outside. Viterbi runs over all
        stretches of one length at once."""
        if not sequences:
            return []
        gap = np.zeros(PAD, np.int32)
        flat = np.concatenate([gap, *(x for r in sequences for x in (r, gap))])
        size = np.array([len(r) for r in sequences], np.int64)
        start = PAD + np.cumsum(size + PAD) - size - PAD
        margins = self.margins(flat)
        parts = [(i, lo, hi) for i, (a, n) in enumerate(zip(start.tolist(), size.tolist(), strict=True))
                 for lo, hi in self.stretches(margins[a - PAD: a - PAD + n])]
        out, by_size = [], {}
        for part in parts:
            by_size.setdefault(part[2] - part[1], []).append(part)
        move, k = self.transitions(), len(STATES)
        for n, alike in by_size.items():
            step = max(1, BLOCK_WORDS // n)
            for at in range(0, len(alike), step):
                some = alike[at: at + step]
                text, lo, hi = np.array(some).T
                e = self.emissions(flat, (start[text] + lo)[:, None] + np.arange(n))
                best = e[:, 0] + np.where((lo == 0)[:, None], move[k], move[0])
                back = np.zeros((n, len(some), k), np.int8)
                for t in range(1, n):
                    score = best[:, :, None] + move[:k]
                    back[t] = score.argmax(axis=1)
                    best = score.max(axis=1) + e[:, t]
                path = np.zeros((len(some), n), np.int8)
                path[:, -1] = (best + np.where((hi == size[text])[:, None], 0.0, move[:k, 0])).argmax(axis=1)
                for t in range(n - 1, 0, -1):
                    path[:, t - 1] = back[t, np.arange(len(some)), path[:, t]]
                out += [(i, first, states) for (i, first, _), states in zip(some, path, strict=True)]
        return out

    def decode(self, sequences: list[list[str]]) -> list[np.ndarray]:
        """Best states of whole sequences of words."""
        out = [np.zeros(len(s), np.int8) for s in sequences]
        for i, lo, states in self.marked([self.numbers(s) for s in sequences]):
            out[i][lo: lo + len(states)] = states
        return out


class _Table:
    """The labelled sequences side by side, for forward-backward over all at once."""

    def __init__(self, active: list[list[list[int]]], states: list[list[int]], k: int):
        self.size = np.array([len(s) for s in states])
        n, width = len(states), int(self.size.max())
        self.there = np.arange(width) < self.size[:, None]
        self.feature = np.array([f for seq in active for at in seq for f in at])
        self.place = np.array([i * width + t for i, seq in enumerate(active) for t, at in enumerate(seq) for _ in at])
        self.seen = np.zeros((n, width, k))
        self.moves = np.zeros((k + 1, k))
        for i, s in enumerate(states):
            self.seen[i, np.arange(len(s)), s] = 1
            for a, b in zip([k, *s], s, strict=False):
                self.moves[a, b] += 1

    def gradient(self, emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Observed minus expected counts of features and of moves."""
        n, width, k = self.seen.shape
        e = np.zeros((n * width, k))
        np.add.at(e, self.place, emit[self.feature])
        e = e.reshape(n, width, k)
        f, b = np.zeros_like(e), np.zeros_like(e)
        f[:, 0] = move[k] + e[:, 0]
        for t in range(1, width):
            ahead = np.logaddexp.reduce(f[:, t - 1, :, None] + move[:k], axis=1) + e[:, t]
            f[:, t] = np.where(self.there[:, t, None], ahead, f[:, t - 1])
        for t in range(width - 2, -1, -1):
            back = np.logaddexp.reduce(move[:k] + (e[:, t + 1] + b[:, t + 1])[:, None, :], axis=2)
            b[:, t] = np.where(self.there[:, t + 1, None], back, 0.0)
        z = np.logaddexp.reduce(f[:, -1], axis=1)[:, None, None]
        p = np.exp(f + b - z) * self.there[:, :, None]
        out = np.zeros_like(emit)
        np.add.at(out, self.feature, (self.seen - p).reshape(n * width, k)[self.place])
        pair = np.exp(f[:, :-1, :, None] + move[:k] + (e + b)[:, 1:, None, :] - z[..., None]) * self.there[:, 1:, None, None]
        return out, self.moves - np.concatenate([pair.sum(axis=(0, 1)), p[:, 0].sum(axis=0)[None]])


class _Numbers(dict):
    """Word -> signature row, filled as words come; long words are not kept."""

    def __init__(self, field: Field):
        super().__init__()
        self.field = field

    def __missing__(self, word: str) -> int:
        got = self.field.row(word)
        if len(word) <= 40:
            self[word] = got
        return got

    def __reduce__(self):  # travels empty, with its field
        return _Numbers, (self.field,)


def blocks_of(text: str) -> list[tuple[int, int]]:
    """The text in pieces that end before white space."""
    out, at = [], 0
    while at < len(text):
        gap = _SPACE.search(text, at + BLOCK_CHARS)
        end = gap.start() if gap else len(text)
        out.append((at, end))
        at = end
    return out


def added_spans(texts: list[str], base: list[list[tuple[str, int, int]]], field: Field) -> list[list[tuple[str, int, int]]]:
    """Spans of the field per text, without those that touch a base span."""
    blocks = [blocks_of(t) for t in texts]
    rows, sizes = [], []
    for t, cut in zip(texts, blocks, strict=True):
        each = [field.numbers(t[a:b].split()) for a, b in cut]
        sizes.append([len(x) for x in each])
        rows.append(np.concatenate(each) if each else np.zeros(0, np.int32))
    marked: dict[int, dict[int, str]] = {}  # text -> place of a marked word -> state
    for i, lo, states in field.marked(rows):
        for j in np.flatnonzero(states).tolist():
            marked.setdefault(i, {})[lo + j] = STATES[states[j]]
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for i, states in marked.items():
        where, first = {}, 0
        for (a, b), n in zip(blocks[i], sizes[i], strict=True):
            if any(first <= w < first + n for w in states):
                where.update((w, m.span()) for w, m in enumerate(_WORD.finditer(texts[i], a, b), first) if w in states)
            first += n
        open_: list | None = None
        for w in sorted(states):
            name, (a, b) = states[w], where[w]
            if name[0] == "I":  # goes on from the word before: an inside state follows only its own kind
                open_[2] = b
                continue
            if open_:
                out[i].append(tuple(open_))
            open_ = [name[2:], a, b]
        out[i].append(tuple(open_))
    for i, got in enumerate(out):
        kept = []
        for kind, a, b in got:
            while b > a and texts[i][b - 1] in ".,;:!?\"'|":
                b -= 1
            if b > a and not any(a < e and s < b for _, s, e in base[i]):
                kept.append((kind, a, b))
        out[i] = kept
    return out


def _listed(spans: list[tuple[str, int, int]]) -> str:
    order = {k: n for n, k in enumerate(ADDED)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (order[x[0]], x[1], x[2])))


def _find(batches: Iterator[pa.RecordBatch], text: str, ident: str, shared) -> Iterator[pa.RecordBatch]:
    field: Field = shared.value
    for batch in batches:
        for part in slices(batch, text):
            texts = [t or "" for t in part[text].to_pylist()]
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, base, field)
            counts = [pa.array([sum(k == kind for k, _, _ in b) for b in base], pa.int64()) for kind in KINDS]
            digest = [hashlib.sha256(_listed(b).encode()).hexdigest() for b in base]
            yield pa.record_batch([part[ident], *counts, pa.array(digest, pa.string()),
                                   pa.array([_listed(b + m) for b, m in zip(base, more, strict=True)], pa.string())],
                                  names=[ident, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def find(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Counts and digest of the base spans, and all spans as kind:start:end."""
    shared = docs.sparkSession.sparkContext.broadcast(Field())
    schema = T.StructType([*fields(docs, ident), *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
    return docs.select(ident, text).mapInArrow(lambda it: _find(it, text, ident, shared), schema)


def redact(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in angle brackets."""
    out, at = [], 0
    for kind, s, e in sorted(((k, int(s), int(e)) for k, s, e in (x.split(":") for x in spans.split(",") if x)), key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
            at = e
    return "".join([*out, text[at:]])
