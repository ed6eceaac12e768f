"""Token alignment, WARC archives and conversation repair on small tables."""

import collections
import glob
import gzip
import hashlib
import random
import zlib

import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedkiln.llm import queries, token_align, turn_repair, warc
from tests.llm.helpers import AWKWARD, docs_of, prose

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# token alignment ------------------------------------------------------------

def tokens_brute(a, b, alphabet, text):
    """(ids, ends) of both sides by the libraries on the whole text, or None."""
    if not text:
        return None
    raw, out = (" " + text).encode(), []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    spelled_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
    spelled_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    for ids, spelled in ((ids_a, spelled_a), (ids_b, spelled_b)):
        if b"".join(spelled) != raw:
            return None
        at, ends = 0, []
        for s in spelled:
            at += len(s)
            ends.append(at)
        out.append((ids, ends))
    return out


def align_brute(rows):
    a, b = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    a.encode_special_tokens = True
    alphabet = token_align.byte_alphabet()
    found, count = [], collections.Counter()
    for ident, text in rows:
        both = tokens_brute(a, b, alphabet, text)
        if both is None:
            found.append((ident, None))
            continue
        (ids_a, end_a), (ids_b, end_b) = both
        at_a, at_b = dict(zip(end_a, ids_a)), dict(zip(end_b, ids_b))
        links = [(at_a[e], at_b[e]) for e in end_a if e in at_b]
        count.update(links)
        overlaps = sum(max(s, t) < min(e, f) for s, e in zip([0, *end_a], end_a) for t, f in zip([0, *end_b], end_b)) if len(end_a) < 400 else None
        cuts = [0] + [e for e in end_a if e in at_b]
        groups = ";".join(",".join(str(i) for i, e in zip(ids_a, end_a) if s < e <= t) + "|" + ",".join(str(i) for i, e in zip(ids_b, end_b) if s < e <= t)
                          for s, t in zip(cuts, cuts[1:])) if len(end_a) < 4000 else None
        found.append((ident, (len(ids_a), len(ids_b), len(cuts) - 1, links, groups, overlaps)))
    most = collections.defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for ident, x in found:
        if x is None:
            out.append((ident, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, groups, _ = x
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups is not None else None
        out.append((ident, n_a, n_b, n_groups, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), sha))
    return out, {ident: x[5] for ident, x in found if x}


ODD = [(20, "a▁b"), (21, "<|endoftext|> <s></s> <unk> <0x0A>"), (22, "  lead  and   trail  "), (23, "a\n  b\r\n\t c　d\x85e \x1c f"),
       (24, " "), (25, "᠆ ᠎ x​ y"), (26, "漢字かな交じり文 без пробелов"), (27, "it's we'll 12 345,67 -- !!?"), (None, "null id"), (27, "it's we'll 12 345,67 -- !!?"),
       (28, "word " * 900), (29, "\x00 \x7f \xa0\xa0 z")]


@pytest.mark.parametrize("window", [1 << 20, 40])
def test_alignment_against_brute_force(spark, window):
    rows = [r for r in AWKWARD if r[0] not in (7, 8)] + [(7, "x" * 3000), (8, prose(8, 900))] + ODD + [(100 + i, prose(i, 60).title()) for i in range(25)]
    got = token_align.report(docs_of(spark, rows).repartition(5), A_FILE, B_FILE, window=window)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "n_best", "count_sum"]
    want, overlaps = align_brute(rows)
    out = got.collect()
    assert collections.Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out) == collections.Counter(want)
    assert sum(overlaps[r.doc_id] is not None for r in out if r.doc_id in overlaps) > 30
    assert all(r.n_overlaps == overlaps[r.doc_id] for r in out if r.doc_id is not None and overlaps.get(r.doc_id) is not None)


def test_groups_cover_the_text(spark):
    rows = [(1, "Hello  there, wörld"), (2, None), (3, "a▁b"), (4, prose(4, 300))]
    got = token_align.groups(spark.createDataFrame(rows, "doc_id long, text string"), A_FILE, B_FILE, window=50).collect()
    for ident, text in ((1, rows[0][1]), (4, rows[3][1])):
        own = sorted((r for r in got if r.doc_id == ident), key=lambda r: r.group)
        assert [r.group for r in own] == list(range(len(own)))
        assert own[0].start == 0 and own[-1].end == len((" " + text).encode()) and all(x.end == y.start for x, y in zip(own, own[1:]))
        spelled = ";".join(",".join(map(str, r.a)) + "|" + ",".join(map(str, r.b)) for r in own)
        report = {r.doc_id: r for r in token_align.report(spark.createDataFrame(rows, "doc_id long, text string"), A_FILE, B_FILE).collect()}
        assert hashlib.sha256(spelled.encode()).hexdigest() == report[ident].groups_sha256
    assert {r.doc_id for r in got} == {1, 4}


def test_alignment_of_an_empty_table_and_a_very_long_text(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.report(empty, A_FILE, B_FILE).count() == 0 and token_align.groups(empty, A_FILE, B_FILE).count() == 0
    rows = [(7, "x" * 200_000), (8, prose(8, 30_000))]
    got = {r.doc_id: r for r in token_align.report(spark.createDataFrame(rows, "doc_id long, text string"), A_FILE, B_FILE, window=5000).collect()}
    want, _ = align_brute(rows)
    assert all(tuple(got[w[0]][c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")) == w[1:7] for w in want)


# WARC -----------------------------------------------------------------------

BIG = "Z" * 120
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2 x\ny", BIG), (3, None, BIG), (3, "http://a/3", BIG), (4, "http://a/4", "short"), (5, "u", "short"),
         (6, "u", None), (7, "u", ""), (None, "u", BIG), (None, "u", "Y" * 200), (None, "u", "Y" * 200), (8, "u", "é漢" * 60), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 20),
         (1, "http://a/1", BIG), (10, "u", "".join(chr(32 + i * 7919 % 90) for i in range(300_000)))]


def warc_brute(rows):
    least = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 100 and i is not None:
            least[h] = min(least.get(h, i), i)
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        first = least.get(h)
        revisit = first is not None and i != first
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return collections.Counter(out)


def pages_of(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("payload", "ident", "kind", "first", "digest", "_digest", "value"):
        df = df.withColumn(c, F.lit(c))
    return df


def as_ids(df):
    return df.select(warc.id_of(F.col("record_id"), "long").alias("page_id"), "payload_bytes", "payload_digest", "warc_type",
                     warc.id_of(F.col("refers_to"), "long").alias("refers_to"), "error")


@pytest.mark.parametrize("small", [100_000, 0])
def test_warc_round_trip(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(warc, "SMALL", small)
    warc.write_archive(pages_of(spark, PAGES).repartition(3), str(tmp_path / "w"))
    for size in (37, 700, 16 << 20):  # ranges that cut members and even the magic
        got = as_ids(warc.read_archive(spark, str(tmp_path / "w"), size)).collect()
        assert collections.Counter(tuple(r)[:5] for r in got) == warc_brute(PAGES)
        assert all(r.error is None for r in got)
    back = warc.read_archive(spark, str(tmp_path / "w")).filter("warc_type = 'response'").collect()
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in back)
    assert {r.target_uri for r in back if r.record_id.endswith(":page:1")} == {"http://a/1"}


def test_archives_are_plain_gzip(spark, tmp_path):
    warc.write_archive(pages_of(spark, PAGES).coalesce(1), str(tmp_path / "w"))
    (name,) = glob.glob(str(tmp_path / "w" / "part-*"))
    with gzip.open(name) as f:  # the standard reader takes all members, and nothing is left over
        assert f.read().count(b"WARC-Record-ID") == len(PAGES)
    with open(name, "rb") as f:
        unpack = zlib.decompressobj(31)
        first = unpack.decompress(f.read())
    assert unpack.eof and first.count(b"WARC-Record-ID") == 1 and first.endswith(b"\r\n\r\n")


def test_members_of_sixteen_mb_end_with_a_zero(monkeypatch):
    raw = b"WARC/1.1\r\n" + b"\0" * (17 << 20)
    made = warc.member(raw, 1)
    assert made[-1] == 0 and gzip.decompress(made) == raw


class Held:
    """A file in memory, as the reader sees one."""

    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at: at + n]


def records(data, cuts):
    edges = [0, *cuts, len(data)]
    return [r for s, e in zip(edges, edges[1:]) if s < e for r in warc.records_in(Held(data), "f", s, e)]


def test_every_record_is_owned_once_wherever_ranges_fall():
    r = random.Random(3)
    noise = bytes(r.randrange(256) for _ in range(3000)) + warc.MAGIC * 50
    made = []
    for i in range(12):
        payload = [b"<p>%d</p>" % i * 40, noise, b"", warc.MAGIC * 200][i % 4]
        block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
        head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:{i}>\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n"
        made.append(warc.member(head.encode() + block + b"\r\n\r\n", [6, 0][i % 2]))  # stored members show the magic bytes of their payload
    data = b"".join(made)
    want = [sum(map(len, made[:i])) for i in range(12)]
    assert data.count(warc.MAGIC) > 500
    for step in (1, 2, 3, 50, 333, 5000, len(data)):
        got = records(data, range(step, len(data), step))
        assert [x["offset"] for x in got] == want and [x["length"] for x in got] == [len(m) for m in made]
        assert [x["record_id"] for x in got] == [f"urn:x:{i}" for i in range(12)] and not any(x["error"] for x in got)


def test_damaged_and_cut_records_are_told_and_the_rest_is_read():
    r = random.Random(4)
    payload = bytes(r.randrange(256) for _ in range(9000))
    digest = hashlib.sha256(payload).hexdigest()
    whole = [warc.member(warc._record("response", str(i), "u", None, digest, 9000, payload, "d")) for i in range(3)]
    broken = bytearray(whole[1])
    broken[-8] ^= 0xFF  # its checksum
    wrong = warc.member(warc._record("response", "9", "u", None, digest, 9000, payload[::-1], "d"))
    got = records(whole[0] + bytes(broken) + wrong + whole[2] + whole[0][:5000], [100, 9700])
    assert [(r["record_id"][-1], r["error"]) for r in got] == [("0", None), ("1", "damaged"), ("9", "wrong digest"), ("2", None), ("0", "cut off")]


def test_warc_of_empty_tables(spark, tmp_path):
    warc.write_archive(pages_of(spark, PAGES).limit(0), str(tmp_path / "w"))
    assert warc.read_archive(spark, str(tmp_path / "w")).count() == 0


# conversations ----------------------------------------------------------------

NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def cheapest_brute(rows):
    """All edits of (role, text, must_go, truncated): least cost, then least string."""
    best = None

    def go(i, state, cost, audit, left, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and state in (0, 3) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, left)
        if inserts < 2:
            to, name = NEXT[state]
            go(i, to, cost + 5, audit + "I", (*left, (name, "")), inserts + 1)
        if i == len(rows):
            return
        role, text, must_go, truncated = rows[i]
        extra = 5 if truncated else 0
        go(i + 1, state, cost + 2, audit + "D", left, 0)
        if not must_go:
            if (state, role[:1]) in KEPT:
                go(i + 1, KEPT[state, role[:1]], cost + extra, audit + "K", (*left, (role, text)), 0)
            to, name = NEXT[state]
            go(i + 1, to, cost + extra + 1, audit + "R", (*left, (name, text)), 0)

    go(0, 0, 0, "", (), 0)
    return best


def conversation_brute(turns):
    """turns: (turn, role, text) of one conversation after damage."""
    space = "\x20\x09\x0a\x0b\x0c\x0d"
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in turns), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    n = collections.Counter()
    seen, edits = set(), []
    for _, role, text in rows:
        bare = text.strip(space)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        n[fault] += 1
        seen.add((role, text))
        edits.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, left = cheapest_brute(edits)
    whole = "\n".join(f"{r}:{t}" for r, t in left)
    return gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest()


def random_turns(seed, conversations, most):
    r = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(r.randint(1, most)):
            role = r.choice(["user", "assistant", "system", "user", "assistant", "", None, "tool", "uncle", "Ü"])
            text = r.choice([f"w{t}.", f"w{t}", "same!", "same", "", " \n", None, f"é{t}? ", "a.b", "x. "])
            rows.append((c, r.choice([t, t, t, t + 1, None]), role, text))
    return rows


def turns_of(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("_id", "_key", "copies", "_turn", "edit", "place"):
        df = df.withColumn(c, F.lit(c))
    return df


@pytest.mark.parametrize("small", [100_000, 0])
def test_repair_against_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(turn_repair, "SMALL", small)
    rows = random_turns(1, 150, 7) + [(None, 0, "user", "hi."), (None, 1, "assistant", "yo.")]
    rows += rows[:20]  # repeated rows
    by = collections.defaultdict(list)
    for c, *row in rows:
        by[c].append(row)
    df = turns_of(spark, rows).repartition(7)
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.report(df).collect()}
    assert got == {c: conversation_brute(x) for c, x in by.items()}
    left = collections.defaultdict(list)
    for r in sorted(turn_repair.repair(df).collect(), key=lambda r: r.place):
        left[r.conv_id].append(r)
    for c, x in got.items():
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in left[c]).encode()).hexdigest() == x[-1]
        assert "".join(r.edit for r in left[c]) == x[-2].replace("D", "") and [r.place for r in left[c]] == list(range(len(left[c])))


def test_damage_is_dealt_by_id_and_turn(spark):
    rows = [(c, t, "assistant", "One. Two! three?") for c in range(40) for t in range(10)] + [(1, None, None, None), (None, None, "user", "q")]
    got = {(r.conv_id, r.turn): r for r in turn_repair.damage(turns_of(spark, rows)).collect()}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        want = ("user" if kind == 4 else role, "" if kind == 1 else text.replace(".", "").replace("!", "").replace("?", "") if kind == 2 else text,
                {0: 0, 3: 2}.get(kind, 1))
        assert (got[c, t].role, got[c, t].text, got[c, t].copies) == want


def test_a_conversation_without_rows_and_empty_tables(spark):
    df = turns_of(spark, [(1, 0, "user", "a."), (2, 5, "user", "b.")]).withColumn("copies", F.when(F.col("conv_id") == 1, 0).otherwise(2))
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.report(df, copies="copies").collect()}
    assert got[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[2] == conversation_brute([(5, "user", "b.")] * 2)
    none = turns_of(spark, [(1, 0, "u", "a")]).limit(0)
    assert turn_repair.report(none).count() == 0 and turn_repair.repair(none).count() == 0


def test_memory_stays_at_the_unresolved_end():
    r = random.Random(9)
    out = []
    s = turn_repair.Survivors(lambda *x: out.append(x[0]))
    most = 0
    for i in range(20_000):
        s.add(r.choice(["user", "assistant", "system", "tool"]), f"t{i}.", r.random() < 0.1, r.random() < 0.1)
        most = max(most, len(s.rows))
    s.end()
    assert most < 500 and len([e for e in out if e != "I"]) == 20_000


def test_a_conversation_of_many_batches(spark):
    n = 30_000
    rows = [(1, t, ("user", "assistant")[t % 2], f"t{t}.") for t in range(n)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        (got,) = turn_repair.report(turns_of(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got.audit == "K" * n and got.cost == 0
    assert got.repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in rows).encode()).hexdigest()


def test_registered_queries(spark, tmp_path):
    d = str(tmp_path)
    pages_of(spark, PAGES).select("page_id", "url", "html").write.parquet(f"{d}/pages.parquet")
    got = queries.op12_warc(spark, d).collect()
    assert collections.Counter(tuple(r) for r in got) == warc_brute(PAGES)
    rows = random_turns(4, 60, 6)
    spark.createDataFrame(pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype(object).where(lambda x: x.notna(), None),
                          "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    by = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        by[c] += [(t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    got = {r.conv_id: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, d).collect()}
    assert got == {c: conversation_brute(x) for c, x in by.items()}
    docs = [(i, t) for i, t in ODD if i not in (28,)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    want, _ = align_brute(docs)
    got = queries.op11_token_alignment(spark, d).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


def test_arrow_types_of_ids(spark):
    df = spark.createDataFrame([("x", 1, "user", "a."), ("y", 1, "user", "b.")], "conv_id string, turn int, role string, text string")
    assert {r.conv_id for r in turn_repair.report(df).collect()} == {"x", "y"}
    assert pa.types.is_int64(pa.array([1]).type)
