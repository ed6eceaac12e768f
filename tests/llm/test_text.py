"""Decontamination, tokenising, sharding, classifiers and the pipeline on small tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from feedkiln.llm import byte_bpe, decontaminate, kd_shard, language_gru, pii_crf, queries, toxicity_gbt
from tests.llm.helpers import AWKWARD, docs_of, prose
from tests.llm.test_dedup import WORD, closure, lines_brute, lower, simhash_brute

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# decontamination ------------------------------------------------------------

def windows_brute(text, items, w):
    words = re.findall(WORD, lower(text))
    hit, ids, longest = set(), set(), 0
    for i, t in items:
        item = re.findall(WORD, lower(t))
        n = min(len(item), w)
        for a in range(len(item) - n + 1) if n and i is not None else ():
            for p in range(len(words) - n + 1):
                if words[p: p + n] == item[a: a + n]:
                    hit.update(range(p, p + n))
                    ids.add(str(i))
                    k = n
                    while p + k < len(words) and a + k < len(item) and words[p + k] == item[a + k]:
                        k += 1
                    longest = max(longest, k)
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit), longest


def bench_rows():
    return [(1, prose(1, 30)), (2, prose(2, 12)), (3, "short item here"), (10, ""), (11, None), (None, prose(9, 20)), (12, prose(1, 30)),
            (13, "w w w w w w w w w w w w")]


def contaminated_rows():
    some = [(100 + i, prose(50 + i, 40) + " " + " ".join(prose(1 + i % 3, 30).upper().split()[i % 7: i % 7 + 8 + i % 6])) for i in range(30)]
    return some + [(200, "A short, ITEM here!"), (201, "w " * 40), (202, prose(7, 9000) + " " + prose(2, 12) + " " + prose(6, 9000))] + \
        [r for r in AWKWARD if r[0] not in (7, 8)]


def test_decontamination_against_brute_force(spark, monkeypatch):
    bench = spark.createDataFrame(bench_rows(), "item_id long, text string")
    rows = contaminated_rows()
    want = collections.Counter((i, *windows_brute(t, bench_rows(), 10)) for i, t in rows)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match"]
    for block in (16 << 20, 100):  # the second makes several benchmark blocks
        found = decontaminate.report(docs_of(spark, rows if block > 100 else [r for r in rows if r[0] not in (5, None)]), bench, 10)
        if block == 100:
            monkeypatch.setattr(decontaminate.benchmark_blocks, "__defaults__", (block,))
            found = decontaminate.report(docs_of(spark, [r for r in rows if r[0] not in (5, None)]), bench, 10)
        got = collections.Counter(tuple(r[n] for n in names) for r in found.collect())
        assert got == (want if block > 100 else collections.Counter({k: n for k, n in want.items() if k[0] not in (5, None)}))
    kept = decontaminate.remove_contaminated(docs_of(spark, rows), bench, 10)
    assert kept.columns == docs_of(spark, rows).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(k[0] or 0 for k, n in want.items() for _ in range(n) if not k[5])


def test_benchmark_blocks_keep_every_row(spark, monkeypatch):
    a, b = prose(1, 30, ends=False), prose(2, 12, ends=False)
    rows = contaminated_rows() + [(None, a), (None, b), (None, None), (300, a), (300, b + " " + b), (300, a)]
    # item 1 has two texts whose windows follow on along one diagonal
    bench = [*bench_rows(), (1, " ".join(["q"] * 15 + a.split()[15:] + ["q"] * 9))]
    docs, items = docs_of(spark, rows), spark.createDataFrame(bench, "item_id long, text string")
    whole = collections.Counter(map(tuple, decontaminate.report(docs, items, 10).collect()))
    monkeypatch.setattr(decontaminate.benchmark_blocks, "__defaults__", (100,))
    assert len(list(decontaminate.whole_items(decontaminate.benchmark_blocks(items.orderBy("item_id"))))) > 2
    assert collections.Counter(map(tuple, decontaminate.report(docs, items, 10).collect())) == whole
    assert sum(whole.values()) == len(rows)


def test_shards_of_words_find_the_same(monkeypatch):
    from feedkiln.llm.common import hashed_words
    ids, texts = zip(*[(str(i), t) for i, t in bench_rows() if i is not None and t], strict=True)
    items = decontaminate.Items(list(ids), list(texts), 10)
    hashes, begin = hashed_words(pa.array([t for _, t in contaminated_rows()]))
    out = []
    for shard in (1 << 20, 500, 37):
        monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
        cover = np.zeros(len(hashes) + 1, np.int64)
        runs = decontaminate.longest(decontaminate.find(hashes, begin, items, cover))
        out.append((np.cumsum(cover).tolist(), runs.tolist()))
    assert out[0] == out[1] == out[2] and len(out[0][1][0]) > 20


def test_suffixes_stand_in_the_order_of_their_words():
    code = np.random.default_rng(5).integers(0, 3, 400)
    order = decontaminate.suffix_array(code, 27)
    keys = [(*code[i: i + 27].tolist(), *[decontaminate.CODE] * (27 - len(code[i: i + 27]))) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(400))


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontaminate.report(docs_of(spark, AWKWARD), none).collect())
    assert decontaminate.report(docs_of(spark, []).limit(0), none).count() == 0


# byte-level BPE -------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    with open(RANKS, "rb") as f:
        return byte_bpe.Vocabulary(f.read(), public_tokenizers.PATTERN)


def test_bpe_equals_the_public_library(spark, vocabulary):
    r = random.Random(8)
    rows = [(i, t) for i, t in AWKWARD] + [(300 + i, "".join(r.choice("ab 'stlreé \n\t1.€漢\U0001f600\x85\xa0\x1c<|endoftext|>")
                                            for _ in range(r.randrange(300)))) for i in range(60)]
    rows += [(400, "a" * 5000), (401, "ab" * 3000), (402, "".join(r.choice("abcdefgh") for _ in range(6000)))]
    rank = {t: i for i, t in vocabulary.token.items()}
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=rank, special_tokens={})
    want = collections.Counter()
    for i, t in rows:
        ids = theirs.encode_ordinary((t or "") if (t or "").count("x") < 1000 else "")
        if (t or "").count("x") >= 1000:
            ids = np.frombuffer(vocabulary.encode([t])[0], "<u4").tolist()  # the library is slow on one very long piece
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    got = byte_bpe.digests(docs_of(spark, rows), RANKS, public_tokenizers.PATTERN).collect()
    assert collections.Counter(map(tuple, got)) == want
    encoded = byte_bpe.encode(docs_of(spark, rows), RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert collections.Counter(map(tuple, back)) == collections.Counter((i, t or "") for i, t in rows)
    assert byte_bpe.digests(docs_of(spark, []).limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_and_short_pieces_merge_alike(vocabulary):
    r = random.Random(9)
    pieces = ["".join(r.choice("abcther ") for _ in range(r.randint(2, 200))).encode() for _ in range(300)] + [b"a" * 77, b"the" * 50]
    out = vocabulary.merge(pieces)
    assert all(vocabulary.whole.get(p) == o or vocabulary.merge_long(p) == o for p, o in zip(pieces, out, strict=True))


# sharding -------------------------------------------------------------------

def test_shards_hold_equal_bytes(spark):
    r = random.Random(10)
    rows = [(i, prose(i, r.randint(1, 120))) for i in range(900)] + [(2000 + i, prose(1, 60)) for i in range(450)]
    docs = docs_of(spark, rows, source=F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 7)))
    got = kd_shard.shard(docs, ["doc_id", "source"], 6).collect()
    assert sorted(g["doc_id"] for g in got) == sorted(i for i, _ in rows)
    sizes, slots, copies = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    text = dict(rows)
    for g in got:
        assert g["size"] == len(text[g["doc_id"]].encode()) + 8 and g["text_crc32"] == zlib.crc32(text[g["doc_id"]].encode())
        sizes[g["shard"]] += g["size"]
        slots[g["shard"]].append(g["slot"])
        copies[text[g["doc_id"]]].add(g["shard"])
    assert set(sizes) == set(range(6)) and max(sizes.values()) - min(sizes.values()) <= 0.05 * sum(sizes.values()) / 6
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(s) > 1 for s in copies.values()) <= 6  # only texts that a cut meets, or the hot one


def test_shards_of_awkward_rows(spark):
    got = kd_shard.shard(docs_of(spark, AWKWARD), ["doc_id", "score"], 24).collect()
    assert collections.Counter((g["doc_id"], g["size"]) for g in got) == collections.Counter((i, len((t or "").encode()) + 8) for i, t in AWKWARD)
    assert all(0 <= g["shard"] < 24 for g in got)
    assert kd_shard.shard(docs_of(spark, []).limit(0), ["doc_id"], 4).count() == 0


def test_shards_split_by_whole_strings(spark):
    """Values that share a long prefix: shards are consecutive in the order of the values, as brute force cuts them."""
    r = random.Random(21)
    rows = [(i, prose(i, 40)) for i in range(800)]
    name = {i: f"https://example.org/{'archive/' * 4}{r.choice('abcdefgh')}/é{i % 5}" for i, _ in rows}
    named = spark.createDataFrame(list(name.items()), "doc_id long, source string")
    docs = docs_of(spark, rows).join(named, "doc_id")
    got = kd_shard.shard(docs, ["source"], 8).collect()
    by_shard = collections.defaultdict(list)
    for g in got:
        by_shard[g["shard"]].append((name[g["doc_id"]].encode(), g["size"]))
    assert sorted(by_shard) == list(range(8))
    assert all(max(by_shard[i])[0] <= min(by_shard[i + 1])[0] for i in range(7))
    total = sum(g["size"] for g in got)
    for i in range(8):  # a cut misses its quantile by one unit or the tolerance at most, per level
        assert abs(sum(n for _, n in by_shard[i]) - total / 8) <= 4 * max(g["size"] for g in got) + 0.01 * total / 8


def test_ranks_of_strings(spark):
    r = random.Random(22)
    values = [None, "", "a", "é", "\U0001f600", "z" * 5000] + ["https://x.org/" + "".join(r.choice("ab01") for _ in range(r.randrange(12))) for _ in range(700)]
    df = spark.createDataFrame([(v,) for v in values * 2], "d string")
    got = {x["d"]: x["_rank"] for x in kd_shard.ranks_of(df, "d").collect()}
    assert got == {v: i for i, v in enumerate(sorted({v for v in values if v is not None}, key=str.encode))}
    assert kd_shard.ranks_of(df.limit(0), "d").count() == 0


def test_texts_below_the_bound_are_not_split(spark):
    rows = [(i, prose(i % 300, 30)) for i in range(1500)] + [(5000 + i, "hot " + prose(1, 25)) for i in range(700)]
    docs = docs_of(spark, rows, lang=F.concat(F.lit("language-"), F.col("doc_id") % 3), empty=F.lit(None).cast("string"))
    got = kd_shard.shard(docs, ["lang", "empty"], 4).collect()
    text, total = dict(rows), sum(g["size"] for g in got)
    size, where = collections.Counter(), collections.defaultdict(set)
    for g in got:
        size[text[g["doc_id"]]] += g["size"]
        where[text[g["doc_id"]]].add(g["shard"])
    small = [t for t in size if size[t] <= kd_shard.PIECE * total / 4]
    assert len(small) >= 290 and all(len(where[t]) == 1 for t in small)
    assert len(where["hot " + prose(1, 25)]) > 1 and len(got) == len(rows)


def test_written_shards_hold_the_documents(spark, tmp_path):
    docs = docs_of(spark, [(i, prose(i, 20)) for i in range(40)]).select("doc_id", "text")
    kd_shard.write_shards(docs, kd_shard.shard(docs, ["doc_id"], 4), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 40 and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


# language -------------------------------------------------------------------

def test_gradients_of_the_network():
    net = language_gru.Network(["a", "b", "c"], hidden=5, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(2)
    text, target, weight = r.integers(0, 256, (4, 6), dtype=np.uint8), r.dirichlet(np.ones(3), 4), r.random(4) + 0.5
    grads, _ = net.gradients(text, target, weight)
    for name in net.p:
        for _ in range(4):
            at = (int(text[1, 2]), *(r.integers(0, s) for s in net.p[name].shape[1:])) if name[0] == "x" else tuple(r.integers(0, s) for s in net.p[name].shape)
            old, eps = net.p[name][at], 1e-5
            net.p[name][at] = old + eps
            up = net.gradients(text, target, weight)[1]
            net.p[name][at] = old - eps
            down = net.gradients(text, target, weight)[1]
            net.p[name][at] = old
            assert abs((up - down) / (2 * eps) - grads[name][at]) < 1e-5


def test_language_of_held_out_documents(spark):
    sound = {"en": "the and ing tion with er".split(), "de": "der sch ung ein icht zu".split(), "fr": "eau les oir que ment é".split()}
    r = random.Random(11)
    rows = [(i, " ".join("".join(r.choice(sound[lang]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(3, 60))), lang)
            for i in range(400) for lang in [r.choice(list(sound))]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language_gru.fit(docs.filter("doc_id % 4 != 2"), max_runs=2000)
    got = {g["doc_id"]: g for g in language_gru.predict(docs_of(spark, [r[:2] for r in rows]), net).collect()}
    held = [r for r in rows if r[0] % 4 == 2]
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang in held]) >= 0.95
    assert all(0 <= g["score"] <= 1 and 0 <= g["share"] <= 1 for g in got.values())
    odd = language_gru.predict(docs_of(spark, AWKWARD), net).collect()
    assert len(odd) == len(AWKWARD)
    assert {g["doc_id"]: g["lang_pred"] for g in odd if g["doc_id"] in (1, 2, 3, 10)} == dict.fromkeys((1, 2, 3, 10), "und")
    # what the sharing of equal runs computes is what the network says of the text
    text = rows[0][1]
    p, _ = language_gru.Labeller(net).pool(pa.array([text]))
    logp = sum(net.labels(np.frombuffer(w.encode(), np.uint8)[None])[0].mean(axis=0) for w in text.split())
    assert np.allclose(p[0], np.exp(logp - logp.max()) / np.exp(logp - logp.max()).sum(), atol=1e-4)
    assert language_gru.label_positions(net, "der schung")[0][0] == 0


def test_rare_languages_are_learned(spark):
    r = random.Random(12)
    rows = [(i, prose(i, 40), "ab"[i % 2]) for i in range(600)]
    rows = [(i, t if lang == "a" else " ".join("".join(r.choice("uvwxyz") for _ in range(4)) for _ in t.split()), lang) for i, t, lang in rows]
    # few documents without spaces, so their runs are mostly unique; one has no id
    rare = [(1000 + i, "".join(r.choice("漢字仮名交文") for _ in range(80)), "c") for i in range(3)]
    one = " ".join("".join(r.choice("жклмнр") for _ in range(4)) for _ in range(60))
    rows += rare + [(None, one, "d"), (2000, None, "e"), (2001, "123", "e")]
    net = language_gru.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_docs=60, max_runs=400)
    assert net.languages == ["a", "b", "c", "d"]
    said = [(i, t) for i, t, _ in rare] + [(3000, one), (3001, prose(7, 40)), (3002, "uvxw zyxu wwvu")]
    got = {g["doc_id"]: g["lang_pred"] for g in language_gru.predict(docs_of(spark, said), net).collect()}
    assert got == {1000: "c", 1001: "c", 1002: "c", 3000: "d", 3001: "a", 3002: "b"}


def test_too_many_languages_are_an_error(spark):
    rows = [(i, prose(i, 5), f"l{i}") for i in range(language_gru.MAX_LANGS + 1)]
    with pytest.raises(ValueError, match="languages"):
        language_gru.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_quotas_share_the_bound():
    assert language_gru.quotas({"a": 100_000, "b": 5, "c": 3000}, 4000) == {"b": 5, "c": 1997, "a": 1998}
    assert language_gru.quotas({"a": 1, "b": 9, "c": 9}, 2) == {"a": 1, "b": 1, "c": 1}


def test_language_without_training_rows(spark):
    none = language_gru.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    got = language_gru.predict(docs_of(spark, AWKWARD), none).collect()
    assert {g["lang_pred"] for g in got} == {"und"} and {g["score"] for g in got} == {0.0}


# personal data --------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def spans_brute(text):
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits))))
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and total % 10 == 0 or kind == "phone" and 8 <= len(digits) <= 15):
                yield kind, m.start(), m.end()


def test_base_spans_against_the_patterns(spark):
    r = random.Random(12)
    parts = ["a", ".", "@", "-", "1", "25", "4111 1111 1111 1111", "4111111111111111", "+49 (30) 555-77", "(", ")", " ", "é", "%", ".com", "1.2.3.4", "0"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(4000)] + ["a@b.c@d.e", "1.2.3.4.5.6.7.8", "9" * 3000, "a" * 3000]
    for t in texts:
        assert pii_crf.base_spans(t) == list(spans_brute(t)), t
    rows = [(i, t) for i, t in enumerate(texts[:300])] + [(1000 + k, t) for k, (_, t) in enumerate(AWKWARD)]
    for g in pii_crf.find(docs_of(spark, rows)).collect():
        want = list(spans_brute(dict(rows)[g["doc_id"]] or ""))
        listed = [f"{k}:{s}:{e}" for k, s, e in want]
        assert [g[f"n_{k}"] for k in pii_crf.KINDS] == [sum(w[0] == k for w in want) for k in pii_crf.KINDS]
        assert g["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest() and set(listed) <= set(g["spans"].split(",")) | {""}
    assert pii_crf.find(docs_of(spark, []).limit(0)).count() == 0


def test_the_field_adds_what_patterns_miss():
    field = pii_crf.Field()

    def added(t):
        return [(k, t[a:b]) for k, a, b in pii_crf.added_spans([t], [pii_crf.base_spans(t)], field)[0]]
    assert ("phone", "555-222-9999") in added("please call 555-222-9999 today")
    assert ("name", "Peter Jones") in added("thank you Mr. Peter Jones for it")
    assert ("ip", "10-1-2-3") in added("the host 10-1-2-3 is up")
    for clean in ("in 2015 we had 300 items", "chapter 9 verses 3 to 8", prose(1, 200), "order 55512345 left on 2024-01-05"):
        assert added(clean) == []
    t = "mail a.b@c.de or call +49 30 5557 7788 now"
    assert pii_crf.redact(t, ",".join(f"{k}:{s}:{e}" for k, s, e in pii_crf.base_spans(t))) == "mail <email> or call <phone> now"


def test_viterbi_is_the_best_path():
    field = pii_crf.Field(epochs=15)
    words = "call (017) 555-7713 now".split()
    e = np.array([field.emit[a].sum(axis=0) for a in field.around([field.code(w) for w in words])])
    move, k = field.transitions(), len(pii_crf.STATES)
    import itertools
    best = max(itertools.product(range(k), repeat=len(words)), key=lambda p: move[k, p[0]] + sum(e[t, s] for t, s in enumerate(p))
               + sum(move[a, b] for a, b in itertools.pairwise(p)))
    assert field.decode([words])[0].tolist() == list(best)


def test_names_and_numbers_far_from_any_start():
    field = pii_crf.Field()

    def added(t):
        return [(k, t[a:b]) for k, a, b in pii_crf.added_spans([t], [pii_crf.base_spans(t)], field)[0]]
    for t in ("Please ask Ms. Anna Berg", "Miss Anna Berg agreed", "my name is Anna Berg"):
        assert added(t) == [("name", "Anna Berg")]
    for n in (61, 62, 63, 64, 500):  # a long row of numbers before it cuts nothing
        assert added("17 " * n + "dear Mr. John Smith thank you") == [("name", "John Smith")]
        assert added("12 " * n + "card 4111 1111 1111 1234 was used") == [("card", "4111 1111 1111 1234")]
    for clean in ("these&&& are### words*** with$$$ Signs%%%", "Der Hund und die Katze gehen am Abend nach Haus.", "a b c " * 50):
        assert added(clean) == []
    far = prose(3, 90_000, ends=False) + "\n"  # more than one block of characters and of words
    assert len(pii_crf.blocks_of(far)) > 1
    got = pii_crf.added_spans([far + "dear Mr. John Smith thank you", "", "see Miss Anna Berg"], [[], [], []], field)
    assert got == [[("name", len(far) + 9, len(far) + 19)], [], [("name", 9, 18)]]


def test_skipped_words_are_outside_on_the_best_path():
    r = random.Random(41)
    parts = ["12", "call", "Mr.", "Anna", "Berg", "the", "word", "(030)", "4111", "host", "10-0-0-7", "x@", "a1b2", "Über", "is", "***", "more,", "name"]
    sequences = [[r.choice(parts) for _ in range(r.randrange(40))] for _ in range(120)] + [["12"] * 700, [*["word"] * 300, "Mr.", "Anna", "Berg"]]
    for field in (pii_crf.Field(epochs=4), pii_crf.Field(epochs=40)):
        move, k = field.transitions(), len(pii_crf.STATES)
        for words, got in zip(sequences, field.decode(sequences), strict=True):
            if not words:
                assert len(got) == 0
                continue
            e = np.array([field.emit[a].sum(axis=0) for a in field.around([field.code(w) for w in words])])
            best = move[k] + e[0]  # the plain recursion over all words
            for t in range(1, len(words)):
                best = (best[:, None] + move[:k]).max(axis=0) + e[t]
            score = move[k, got[0]] + e[np.arange(len(words)), got].sum() + sum(move[a, b] for a, b in zip(got, got[1:], strict=False))
            assert abs(score - best.max()) < 1e-6 * max(1, abs(score))


def test_gradient_of_the_field():
    """Against differences of the likelihood, by sums over all paths."""
    import itertools
    r = np.random.default_rng(5)
    k, sizes = 3, [1, 4, 2]
    active = [[sorted(r.choice(6, 2, replace=False).tolist()) for _ in range(n)] for n in sizes]
    states = [r.integers(0, k, n).tolist() for n in sizes]
    emit, move = r.normal(size=(6, k)), r.normal(size=(k + 1, k))

    def likelihood():
        total = 0.0
        for act, st in zip(active, states, strict=True):
            def score(path, act=act):
                return sum(emit[a, s].sum() for a, s in zip(act, path, strict=True)) + sum(move[a, b] for a, b in zip([k, *path], path, strict=False))
            total += score(st) - np.log(sum(np.exp(score(p)) for p in itertools.product(range(k), repeat=len(act))))
        return total
    got = pii_crf._Table(active, states, k).gradient(emit, move)
    for w, g in zip((emit, move), got, strict=True):
        for at in np.ndindex(w.shape):
            w[at] += 1e-5
            up = likelihood()
            w[at] -= 2e-5
            assert abs((up - likelihood()) / 2e-5 - g[at]) < 1e-5
            w[at] += 1e-5


def test_labelled_numbers_are_made_up_and_train_the_field():
    """The trained field tells its own table, held against the written states."""
    field = pii_crf.Field()
    rows = [line.split(" ") for line in pii_crf.LABELLED.strip().splitlines()]
    want = [[w.rpartition("/")[2] if w.rpartition("/")[2] in pii_crf.STATES else "O" for w in row] for row in rows]
    words = [[w.rpartition("/")[0] if s != "O" else w for w, s in zip(row, states, strict=True)] for row, states in zip(rows, want, strict=True)]
    wrong = sum(pii_crf.STATES[a] != b for got, states in zip(field.decode(words), want, strict=True) for a, b in zip(got, states, strict=True))
    assert wrong <= 0.01 * sum(map(len, want))


def test_personal_data_with_repeated_rows_and_clashing_columns(spark):
    rows = [*AWKWARD, (20, "dear Mr. John Smith thank you"), (20, "dear Mr. John Smith thank you")]
    docs = docs_of(spark, rows, spans=F.lit("spans"), n_email=F.lit(5), base_sha256=F.lit(None).cast("string"))
    got = pii_crf.find(docs).collect()
    assert sorted((g["doc_id"] or 0) for g in got) == sorted((i or 0) for i, _ in rows)
    assert [g["spans"] for g in got if g["doc_id"] == 20] == ["name:9:19"] * 2
    assert all(g["spans"] == "" for g in got if g["doc_id"] in (1, 2, 3, 7))


# toxicity -------------------------------------------------------------------

def toxic_tables(spark, n=900):
    r = random.Random(13)
    bad = ["scum", "vile", "stupid", "worthless"]
    rows, labels = [], []
    for i in range(n):
        words, toxic = prose(i, r.randint(10, 60)).split(), r.random() < 0.2
        for _ in range(3 * toxic):
            words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words)))
        if r.random() < 0.8:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_of_held_out_documents(spark):
    rows, labels = toxic_tables(spark)
    docs, marked = docs_of(spark, rows), spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity_gbt.fit(docs, marked)
    got = {g["doc_id"]: g["score"] for g in toxicity_gbt.score(docs, model).collect()}
    held = [(got[i], t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(got) == len(rows) and np.mean([(s >= 0.5) == t for s, t in held]) >= 0.97
    kept = toxicity_gbt.remove_toxic(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}
    odd = toxicity_gbt.score(docs_of(spark, AWKWARD), model).collect()
    assert len(odd) == len(AWKWARD) and all(0 <= g["score"] < 0.5 for g in odd)


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity_gbt.fit(docs_of(spark, AWKWARD), none)
    assert all(g["score"] < 0.01 for g in toxicity_gbt.score(docs_of(spark, AWKWARD), model).collect())
    assert toxicity_gbt.score(docs_of(spark, []).limit(0), model).count() == 0


def test_calibration_is_isotonic():
    r = np.random.default_rng(14)
    p = r.random(500)
    trees = toxicity_gbt.Trees(0.3)
    trees.calibrate(p, (r.random(500) < p ** 2).astype(float))
    y = np.interp(np.linspace(0, 1, 200), *trees.knots)
    assert (np.diff(y) >= -1e-12).all() and np.abs(y - np.linspace(0, 1, 200) ** 2).mean() < 0.1


# the pipeline ---------------------------------------------------------------

def test_pipeline_against_brute_force(spark, tmp_path):
    rows, labels = toxic_tables(spark, 500)
    texts = dict(rows)
    for i in range(0, 60, 3):
        texts[i + 1] = texts[i]  # exact copies
    for i in range(100, 130):
        texts[i] += "\nA shared line\nand one more shared line"
    bench = [(1, prose(1, 30)), (2, prose(2, 25))]
    for i in range(200, 206):
        texts[i] += " " + prose(1 + i % 2, 25)
    texts[300], texts[301] = None, ""
    docs = spark.createDataFrame([(i, t, "en", "s0", len(t or "")) for i, t in texts.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    d = str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    model = toxicity_gbt.fit(docs, spark.read.parquet(f"{d}/labels.parquet"))
    score = {g["doc_id"]: g["score"] for g in toxicity_gbt.score(docs, model).collect()}
    kept = [(i, t) for i, t in texts.items() if score[i] < 0.5]
    kept = [(i, t) for i, t, n in lines_brute(kept) if not n or re.search(r"[^\x09-\x0D\x20]", t)]
    prints = {i: simhash_brute(t) for i, t in kept}
    comp = closure(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    kept = [(i, t) for i, t in kept if comp[i] == i and not windows_brute(t, bench, 10)[4]]
    got = corpus_pipeline.run(spark, d).collect()
    assert {g["doc_id"]: g["decoded_sha256"] for g in got} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in kept}
    assert 0 < len(kept) < 480 and all(len(g["ids"]) == g["n_tokens"] for g in got)
    frame = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, d)
        assert frame.schema.names == docs.schema.names and [f.dataType for f in frame.schema] == [f.dataType for f in docs.schema]


def test_pipeline_of_empty_tables_and_clashing_columns(spark, tmp_path):
    d = str(tmp_path)
    cols = "doc_id long, text string, lang string, source string, n_chars long, _lines_removed string, n_tokens int, _doc int, u int, fold int"
    rows = [(i, t, None, None, None, "x", 1, 2, 3, 4) for i, t in AWKWARD if i != 7]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    for part in ([], rows):
        docs = spark.createDataFrame(part, cols)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, d)
            assert docs.schema.simpleString() == spark.createDataFrame([], cols).schema.simpleString()
        out = corpus_pipeline.STAGES[-1][1](spark, docs, d).collect()
        # one blank text stays for 1, 2, 3; 6 repeats 5; the row without an id stays
        assert sorted(r["doc_id"] or 0 for r in out) == ([0, 1, 5, 5, 8, 9, 10, 11] if part else [])


def test_every_operator_has_its_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.ORACLE) <= set(queries.QUERIES) and len(corpus_pipeline.STAGES) == 5
