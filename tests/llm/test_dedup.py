"""Near-duplicate and repeat operators against brute force on small tables."""

import collections
import random
import re

import numpy as np
import xxhash

from feedkiln.llm import common, embedding_dedup, line_dedup, simhash_bk, sparse_suffix
from tests.llm.helpers import AWKWARD, docs_of, prose

WORD = r"[0-9a-z\x80-\U0010ffff]+"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_join_long_chains(spark):
    r = random.Random(1)
    order = list(range(300))
    r.shuffle(order)
    links = list(zip(order[:200], order[1:201], strict=True)) + [(5000, 5001), (7, 7)]
    got = {x["node"]: x["component"] for x in common.components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = closure({n for e in links for n in e}, links)
    assert all(got.get(n, n) == c for n, c in want.items())
    assert common.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_word_hashes_agree_with_words():
    import pyarrow as pa
    texts = ["Ab ab, aB", None, "", "éé éé", "a", "b" * 3_000_000 + " b"]
    h, begin = common.hashed_words(pa.array(texts))
    words = [re.findall(WORD, lower(t)) for t in texts]
    assert np.diff(begin).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len({*zip(flat, h.tolist(), strict=True)}) == len(set(flat)) == len(set(h.tolist()))


# embeddings -----------------------------------------------------------------

def embed_brute(rows, t=0.9):
    ok = {i: np.array(v, float) / np.max(np.abs(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b])
             and ok[a] @ ok[b] / np.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= t]
    n = collections.Counter(x for e in links for x in e)
    comp = closure([i for i, _ in rows], links)
    return {i: (n[i], comp[i], comp[i] == i) for i, _ in rows}


def test_embeddings_against_brute_force(spark, monkeypatch):
    r = np.random.default_rng(2)
    base = r.standard_normal((60, 16))
    x = np.concatenate([base, base[:20] + 0.1 * r.standard_normal((20, 16)), np.repeat(base[:1], 40, 0) + 0.25 * r.standard_normal((40, 16)),
                        np.repeat(base[1:2], 5, 0)])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [1.0, None] + [0.0] * 14), (904, [float("nan")] * 16), (905, [1e300] * 16),
             (906, [2e300] * 16), (907, [1.0] * 8), (908, [float("inf")] * 16)]
    want = embed_brute(rows)
    for block in (1024, 7):  # the second makes every bucket hot
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
        got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tables=40).collect()
        assert {g["vec_id"]: (g["n_links"], g["component_id"], g["kept"]) for g in got} == want


def test_embeddings_of_an_empty_table_and_single_precision(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(empty).count() == 0
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (None, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted((r["vec_id"] or 0, r["n_links"]) for r in embedding_dedup.near_duplicates(two).collect()) == [(0, 0), (1, 1), (2, 1)]


# SimHash --------------------------------------------------------------------

def simhash_brute(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    grams = [" ".join(words[i: i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_forest_finds_all_within_the_radius():
    r = np.random.default_rng(3)
    fp = r.integers(0, 1 << 63, 400, dtype=np.uint64)
    fp = np.unique(np.concatenate([fp, fp[:200] ^ np.uint64(5), fp[:100] ^ np.uint64(1 << 40), fp[:50] ^ np.uint64(31)]))
    shard = np.sort(r.integers(0, 5, len(fp)))
    forest = simhash_bk.Forest(fp, shard)
    q, m = forest.search(fp, forest.roots[np.searchsorted(forest.root_of_shard, shard)], 3)
    want = {(i, j) for i in range(len(fp)) for j in range(len(fp)) if shard[i] == shard[j] and bin(int(fp[i] ^ fp[j])).count("1") <= 3}
    assert set(zip(q.tolist(), m.tolist(), strict=True)) == want


def test_simhash_groups_against_brute_force(spark, monkeypatch):
    r = random.Random(4)
    rows = [(100 + i, prose(i % 12, 40) + (" " + prose(1000 + i, 1) if r.random() < 0.6 else "")) for i in range(80)]
    rows += [(i, t) for i, t in AWKWARD if i not in (None, 5, 8)] + [(5, prose(5, 70))]
    print_of = {i: simhash_brute(t) for i, t in rows}
    links = [(a, b) for a in print_of for b in print_of if a < b and bin(print_of[a] ^ print_of[b]).count("1") <= 3]
    comp = closure(print_of, links)
    assert len(set(comp.values())) < len(comp) - 10
    want = {i: (f"{print_of[i]:016x}", comp[i]) for i in print_of}
    for shard in (4096, 5):
        monkeypatch.setattr(simhash_bk, "SHARD", shard)
        got = simhash_bk.groups(docs_of(spark, rows)).collect()
        assert {g["doc_id"]: (g["fingerprint"], g["component_id"]) for g in got} == want
    kept = simhash_bk.keep_first(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(set(comp.values()))


def test_simhash_of_awkward_rows(spark):
    got = simhash_bk.groups(docs_of(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD)
    zero = {g["doc_id"]: g["component_id"] for g in got if g["fingerprint"] == "0" * 16}
    assert {i: zero[i] for i in (1, 2, 3)} == {1: 1, 2: 1, 3: 1}
    kept = [r["doc_id"] for r in simhash_bk.keep_first(docs_of(spark, AWKWARD)).collect()]
    assert kept.count(5) == 2 and None in kept and 6 not in kept  # rows with one id are one document
    assert simhash_bk.groups(docs_of(spark, []).limit(0)).count() == 0


# lines ----------------------------------------------------------------------

def lines_brute(rows, m=2, chars=100):
    seen_run, seen_line, gone = set(), set(), collections.defaultdict(set)
    texts = {}
    for i, t in sorted({(i, t) for i, t in rows if i is not None and t is not None}):
        lines = t.split("\n")
        at = [p for p, x in enumerate(lines) if re.search(r"[^\x09-\x0D\x20]", x)]
        for k in range(len(at)):
            run = tuple(lines[p] for p in at[k: k + m])
            if len(run) == m:
                if run in seen_run:
                    gone[i, t].update(at[k: k + m])
                seen_run.add(run)
            if lines[at[k]] in seen_line and len(lines[at[k]]) >= chars:
                gone[i, t].add(at[k])
            seen_line.add(lines[at[k]])
        texts[i, t] = "\n".join(x for p, x in enumerate(lines) if p not in gone[i, t])
    return [(i, texts.get((i, t), t), len(gone[i, t])) for i, t in rows]


def line_rows():
    r = random.Random(6)
    pool = ["l%d" % i for i in range(6)] + ["", "  ", "long " * 30, "x"]
    return [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 9)))) for i in range(60)] + AWKWARD


def test_line_dedup_against_brute_force(spark):
    rows = line_rows()
    for m in (1, 2, 3):
        got = line_dedup.dedup_lines(docs_of(spark, rows), min_lines=m, removed="gone")
        assert got.columns == [*docs_of(spark, rows).columns, "gone"]
        assert sorted(((r["doc_id"] or 0, r["text"] or "", r["gone"]) for r in got.collect())) == \
            sorted((i or 0, t or "", n) for i, t, n in lines_brute(rows, m))


def test_windows_delete_what_maximal_runs_delete(spark):
    rows = [(i, t) for i, t in sorted({(i, t) for i, t in line_rows() if i is not None and t is not None})]
    seqs = {r: [p for p, x in enumerate(r[1].split("\n")) if re.search(r"[^\x09-\x0D\x20]", x)] for r in rows}
    places = collections.defaultdict(list)
    for r, at in seqs.items():
        lines = r[1].split("\n")
        for a in range(len(at)):
            for b in range(a + 1, len(at) + 1):
                places[tuple(lines[p] for p in at[a:b])].append((r, a))
    longer = collections.Counter()  # the most copies of a run with one more line on either side
    for run, found in places.items():
        for part in (run[1:], run[:-1]):
            longer[part] = max(longer[part], len(found))
    gone = collections.defaultdict(set)
    for run, found in places.items():
        if len(run) >= 2 and len(found) > max(1, longer[run]):
            for r, a in found[1:]:
                gone[r].update(seqs[r][a: a + len(run)])
    want = sorted((i, "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i, t]), len(gone[i, t])) for i, t in rows)
    got = line_dedup.dedup_lines(docs_of(spark, rows), min_chars=10 ** 9, removed="gone")
    assert sorted((r["doc_id"], r["text"], r["gone"]) for r in got.collect()) == want and any(n for _, _, n in want)


def test_complete_suffix_array(spark):
    rows = [(i, t) for i, t in line_rows() if i is not None and t is not None][:40]
    ranks, depth = line_dedup.suffix_ranks(line_dedup.first_ranks(docs_of(spark, rows)))
    seqs = {i: [x for x in t.split("\n") if re.search(r"[^\x09-\x0D\x20]", x)] for i, t in rows}
    runs = collections.Counter(tuple(s[k: k + depth]) for s in seqs.values() for k in range(len(s) - depth + 1))
    got = collections.defaultdict(set)
    for r in ranks.collect():
        got[r["_rank"]].add(tuple(seqs[r["_doc"]][r["_i"]: r["_i"] + depth]))
    assert all(len(x) == 1 for x in got.values())
    assert {next(iter(x)) for x in got.values()} == {k for k, n in runs.items() if n > 1} and depth >= 2


def test_runs_are_the_longest_earlier_copies(spark):
    tail = "\n".join("t%d" % i for i in range(13))
    rows = [(i, t) for i, t in line_rows() if i is not None and t is not None][:30]
    rows += [(500, "a\n" + tail), (501, "b\n" + tail), (502, tail + "\nc"), (503, "t3\nt4\nt5\nown"), (504, "z\n" * 21), (505, "z\n" * 6 + "end")]
    seqs = {i: [x for x in t.split("\n") if re.search(r"[^\x09-\x0D\x20]", x)] for i, t in rows}
    at = [(i, k) for i in sorted(seqs) for k in range(len(seqs[i]))]

    def common(x, y):
        pairs = zip(seqs[x[0]][x[1]:], seqs[y[0]][y[1]:], strict=False)
        return next((n for n, (a, b) in enumerate(pairs) if a != b), min(len(seqs[x[0]]) - x[1], len(seqs[y[0]]) - y[1]))
    want = {x: n for j, x in enumerate(at) if (n := max((common(x, y) for y in at[:j]), default=0))}
    found = line_dedup.levels(line_dedup.first_ranks(docs_of(spark, rows)))
    assert max(want.values()) == 20 and len(found) == 5
    runs = line_dedup.copied(found)
    got = [((r["_doc"], r["_i"]), r["_depth"]) for r in runs.collect()]
    assert len(got) == len(want) and dict(got) == want
    top = {(r["_doc"], r["_i"]): (r["_from"], r["_end"]) for r in line_dedup.maximal(runs).collect()}
    reach = {x: max((k + want.get((x[0], k), 0) for k in range(x[1])), default=0) for x in want}
    assert top == {x: (max(x[1], reach[x]), x[1] + n) for x, n in want.items() if x[1] + n > reach[x]}


def test_ranks_are_in_suffix_order(spark):
    rows = [(i, t) for i, t in line_rows() if i is not None and t is not None][:40]
    found = line_dedup.levels(line_dedup.first_ranks(docs_of(spark, rows)))
    line = {(r["_doc"], r["_i"]): r["_rank"] for r in found[0].collect()}
    for n, ranks in enumerate(found):
        by_rank = sorted((r["_rank"], [line[r["_doc"], r["_i"] + j] for j in range(1 << n)]) for r in ranks.collect())
        assert [x for _, x in by_rank] == sorted(x for _, x in by_rank)


def test_line_dedup_of_an_empty_table_and_a_hot_line(spark):
    assert line_dedup.dedup_lines(docs_of(spark, []).limit(0)).count() == 0
    rows = [(i, "hot\nhot\nhot\nown %d" % i) for i in range(300)]
    got = line_dedup.dedup_lines(docs_of(spark, rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got)[:2] == [(0, "hot\nown 0"), (1, "own 1")]


# sparse suffixes ------------------------------------------------------------

def passages_brute(rows, m):
    first, count, words = {}, collections.Counter(), {}
    for i, t in sorted((i, t) for i, t in rows if i is not None):
        words[i] = w = re.findall(WORD, lower(t))
        for k in range(len(w) - m + 1):
            key = tuple(w[k: k + m])
            count[key] += 1
            first.setdefault(key, (i, k))
    out = {}
    for i, w in words.items():
        rep, gone = set(), set()
        for k in range(len(w) - m + 1):
            key = tuple(w[k: k + m])
            if count[key] > 1:
                rep.update(range(k, k + m))
                if first[key] != (i, k):
                    gone.update(range(k, k + m))
        if rep:
            out[i] = (len(rep), len(gone))
    return out


def test_passages_against_brute_force(spark):
    shared = [prose(100 + k, 60, ends=False) for k in range(4)]
    rows = [(i, prose(i, 30) + "\n" + shared[i % 5][: 330 - 3 * i] + "\n" + prose(500 + i, 25) if i % 5 < 4 else prose(i, 90)) for i in range(40)]
    rows += [(200, None), (201, ""), (202, "w " * 500), (203, prose(8, 3000)), (204, "pre " + prose(8, 3000))]
    want = passages_brute(rows, 20)
    assert want
    got = {r["doc_id"]: (r["n_repeated"], r["n_removed"]) for r in sparse_suffix.report(docs_of(spark, rows), 20, 6).collect()}
    assert got == want
    clean = sparse_suffix.remove_repeats(docs_of(spark, rows), 20, 6)
    assert clean.columns == docs_of(spark, rows).columns and clean.count() == len(rows)
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert all(len(re.findall(WORD, lower(texts[i]))) == len(re.findall(WORD, lower(dict(rows)[i]))) - n for i, (_, n) in want.items())
    assert not any(n for _, n in passages_brute(texts.items(), 60).values())


def test_passages_of_awkward_rows(spark):
    got = {r["doc_id"] for r in sparse_suffix.report(docs_of(spark, AWKWARD)).collect()}
    assert got == {5, 6}
    assert sparse_suffix.report(docs_of(spark, []).limit(0)).count() == 0
    assert sparse_suffix.remove_repeats(docs_of(spark, AWKWARD)).count() == len(AWKWARD)


def test_passages_of_repeated_rows(spark):
    long = prose(31, 40, ends=False)
    rows = AWKWARD + [(20, long), (20, long), (20, "pre " + long), (21, long), (22, prose(32, 40)), (22, prose(32, 40))]
    # one id with a passage at one place of two texts
    rows += [(23, prose(33, 40, ends=False) + " left"), (23, prose(33, 40, ends=False) + " right")]
    found = [tuple(r) for r in sparse_suffix.report(docs_of(spark, rows), 20, 6).collect()]
    gone = {r[0]: r[2] for r in found}
    assert len(gone) == len(found)
    assert gone[5] == 70 and gone[20] >= 40 and gone[22] == gone[23] == 40


def test_one_passage_in_every_document(spark):
    """Copies of a passage, alone, in different surroundings and cut at either end."""
    passage = prose(41, 60, ends=False).split()
    rows = [(i, " ".join([*prose(1000 + i, i % 7).split(), *passage[i % 3: 60 - i % 4], *prose(2000 + i, i % 5).split()])) for i in range(150)]
    rows += [(300 + i, " ".join(passage)) for i in range(60)] + [(400 + i, " ".join(passage[k: k + 25])) for i, k in enumerate(range(0, 35, 3))]
    random.Random(2).shuffle(rows)
    got = {r["doc_id"]: (r["n_repeated"], r["n_removed"]) for r in sparse_suffix.report(docs_of(spark, rows).repartition(6), 20, 6).collect()}
    assert got == passages_brute(rows, 20) and len(got) == len(rows)


def test_pieces_of_words_retain_the_same_windows(monkeypatch):
    import pyarrow as pa
    hashes, begin = common.hashed_words(pa.array([prose(i, 400) for i in range(5)] + ["w " * 300, None]))

    def windows():
        out = []
        for gram, doc, start, digest, edge in sparse_suffix.retained(hashes, begin, 20, 6):
            for k in range(len(gram)):
                out += [(int(doc[k]), int(start[k]) + j, int(d), int(gram[k])) for j, d in enumerate(digest[edge[k]: edge[k + 1]])]
        return sorted(out)
    whole = windows()
    monkeypatch.setattr(sparse_suffix, "WORDS", 100)
    assert windows() == whole and len(whole) == sum(max(0, n - 19) for n in np.diff(begin))
