"""Near-duplicate and substring operators against brute force."""

import hashlib
import random

import numpy as np
import pytest

from sluice.llm import near_dedup as N
from sluice.llm import substring_dedup as P
from sluice.llm import suffix_dedup as S
from sluice.llm.common import Scratch
from sluice.llm.components import components
from sluice.llm.words import Words, white_table
from tests_llm_helpers import docs, empty, messy, messy_rows, sentences

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = [x for x in (text or "").translate(LOWER).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = {k: shingles(t) for k, (i, t) in enumerate(rows)}
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i, j = rows[a][0], rows[b][0]
            if i is None or j is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted(((i, len(sets[k]), find(i) if i is not None else None) for k, (i, _) in enumerate(rows)), key=repr)


def near_rows(seed, n_groups=25, copies=6):
    r = random.Random(seed)
    rows = []
    for g in range(n_groups):
        w = sentences(1000 * seed + g, r.choice([3, 8, 30, 60, 150])).split()
        for _ in range(r.randint(1, copies)):
            x = list(w)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                x[r.randrange(len(x))] = "edit%d" % r.randrange(10**6)
            rows.append((r.randrange(10**7), " ".join(x)))
            if r.random() < 0.2:  # chains: an edited copy of an edited copy
                w = x
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed):
    rows = near_rows(seed)
    got = N.near_duplicates(docs(spark, rows)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_messy_rows(spark):
    rows = [r[:2] for r in messy_rows()]
    got = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in N.near_duplicates(messy(spark)).collect()], key=repr)
    assert got == brute_components(rows)
    assert N.near_duplicates(empty(spark)).collect() == []


def test_sketch_is_mergeable_and_locality_sensitive():
    r = np.random.default_rng(0)
    a, b = r.integers(0, 2**63, 400, dtype=np.uint64), r.integers(0, 2**63, 100, dtype=np.uint64)
    one = lambda h: N.sketch(h, np.zeros(len(h), np.int64), np.array([len(h)]), 1024)[0]
    union = one(np.concatenate([a, b]))
    assert (union == np.maximum(one(a), one(b))).all()
    assert abs((union == one(a)).mean() - 0.8) < 0.06  # Jaccard 400 / 500
    assert (one(a) == one(b)).mean() < 0.02


def test_likelihood_keeps_similar_and_drops_distant():
    m, n = 128, np.array([100.0, 100.0, 40.0])
    equal = np.array([90, 20, 100])
    rest = m - equal
    assert N.similar(n, np.array([100.0, 100.0, 100.0]), rest // 2, rest - rest // 2, equal).tolist() == [True, False, False]


def test_star_and_chain_components(spark):
    links = [(1, k) for k in range(2, 200)] + [(k, k + 1) for k in range(300, 340)] + [(500, 500)]
    out = {r.id: r.component for r in components(spark.createDataFrame(links, "u bigint, v bigint"), Scratch(spark, "t"), "c").collect()}
    assert set(out) == set(range(1, 200)) | set(range(300, 341))
    assert all(c == (1 if i < 200 else 300) for i, c in out.items())


# --- suffix dedup -----------------------------------------------------------------------------

def brute_removed(texts, length=200):
    seen = {}
    for b in texts:
        for s in range(len(b) - length + 1):
            seen[b[s:s + length]] = seen.get(b[s:s + length], 0) + 1
    out = []
    for b in texts:
        on = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                on[s:s + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, on) if not y)
        out.append((len(b), sum(on), sum(1 for k in range(len(on)) if on[k] and (not k or not on[k - 1])), hashlib.sha256(kept).hexdigest()))
    return out


def suffix_rows(seed):
    r = random.Random(seed)
    base = [sentences(seed * 100 + k, 150) for k in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(1, 4)):
            t = r.choice(base)
            n = r.choice([150, 199, 200, 201, 260, 500, len(t)])
            s = r.randrange(max(1, len(t) - n))
            parts.append(t[s:s + n])
            parts.append(sentences(r.random(), r.randint(0, 6)))
        rows.append((i, " é ".join(parts)))
    return rows + [(60, "ab" * 300), (61, "x" * 450), (62, "x" * 200), (63, None), (64, ""), (65, rows[0][1])]


@pytest.mark.parametrize("limit", [2000, 2])
def test_removed_bytes_match_brute_force(spark, limit):
    rows = suffix_rows(7)
    want = dict(zip((i for i, _ in rows), brute_removed([(t or "").encode() for _, t in rows])))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(docs(spark, rows), limit).collect()}
    assert got == want
    assert any(0 < w[1] < w[0] for w in want.values())


def test_suffix_dedup_of_messy_rows(spark):
    rows = [(i, t) for i, t, *_ in messy_rows()]
    want = sorted((repr(i), *w) for (i, _), w in zip(rows, brute_removed([(t or "").encode() for _, t in rows])))
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(messy(spark)).collect())
    assert got == want
    assert S.remove_repeats(empty(spark)).collect() == []


def test_prefix_intervals_are_those_of_the_definition():
    r = random.Random(3)
    for _ in range(50):
        words = sorted("".join(r.choice("ab") for _ in range(8)) for _ in range(r.randint(2, 12)))
        lcp = [S.common_prefix(x.encode(), y.encode()) for x, y in zip(words, words[1:])]
        got = {(d, i, j) for d, i, j in S.prefix_intervals(lcp)}
        want = set()
        for i in range(len(words)):
            for j in range(i + 1, len(words)):
                d = min(lcp[i:j])
                if (i == 0 or lcp[i - 1] < d) and (j == len(words) - 1 or lcp[j] < d):
                    want.add((d, i, j))
        assert got == want


def test_maximal_repeats_are_those_of_the_definition():
    r = random.Random(8)
    for _ in range(40):
        lefts = ["".join(r.choice("ab") for _ in range(r.randint(0, 5))).encode() for _ in range(r.randint(2, 9))]
        rights = ["".join(r.choice("ab") for _ in range(r.randint(1, 5))).encode() for _ in lefts]
        got = {(x, y, frozenset(g)) for x, y, g in S.maximal_repeats(lefts, rights, 3)}
        want = set()
        for x in range(6):
            for y in range(6):
                groups = {}
                for k, (a, b) in enumerate(zip(lefts, rights)):
                    if len(a) >= x and len(b) >= y:
                        groups.setdefault((a[len(a) - x:], b[:y]), set()).add(k)
                for g in groups.values():
                    left = {lefts[k][len(lefts[k]) - x - 1:len(lefts[k]) - x] for k in g}
                    right = {rights[k][y:y + 1] for k in g}
                    if len(g) > 1 and x + y >= 3 and (len(left) > 1 or left == {b""}) and (len(right) > 1 or right == {b""}):
                        want.add((x, y, frozenset(g)))
        assert got == want


# --- passages ---------------------------------------------------------------------------------

def test_compact_windows_partition_all_long_runs():
    r = np.random.default_rng(1)
    for n, t in ((1, 1), (40, 1), (60, 7), (200, 46)):
        v = r.integers(0, 2**63, n, dtype=np.uint64)
        l, c, e = P.compact_windows(v, np.array([0]), np.array([n - 1]), t)
        for i in range(n):
            for j in range(i + t - 1, n):
                inside = [(int(c[k])) for k in range(len(c)) if l[k] <= i <= c[k] <= j <= e[k]]
                assert inside == [i + int(np.argmin(v[i:j + 1]))]


def test_windows_of_a_constant_text_are_found_fast():
    n = 200_000
    l, c, e = P.compact_windows(np.full(n, 5, np.uint64), np.array([0]), np.array([n - 1]))
    assert n / 60 < len(c) < n / 10


def test_passages_between_documents(spark):
    shared, other = sentences(50, 70).split(), sentences(51, 90).split()
    edited = list(other)
    edited[30] = "changed"
    hole = list(shared)
    for k in range(4, 70, 6):
        hole[k] = "gap%d" % k
    rows = [(1, sentences(1, 100) + " " + " ".join(shared) + " " + sentences(2, 80)), (2, sentences(3, 30) + " " + " ".join(shared).upper()),
            (3, " ".join(other) + " " + sentences(4, 200)), (4, sentences(5, 300) + " " + " ".join(edited)), (5, sentences(6, 400)),
            (6, " ".join(hole)), (7, " ".join(shared[:40])), (8, " ".join(other[:60]) + " " + sentences(7, 60) + " " + " ".join(other[:60]))]
    text = dict(rows)
    out = P.near_duplicate_passages(docs(spark, rows)).collect()
    assert {(r.first_id, r.doc_id) for r in out} == {(1, 2), (3, 4), (3, 8)}
    for r in out:
        a = text[r.first_id].encode()[r.first_start:r.first_end].decode().lower().split()
        b = text[r.doc_id].encode()[r.start:r.end].decode().lower().split()
        sa, sb = shingles(" ".join(a)), shingles(" ".join(b))
        assert min(len(a), len(b)) >= 50 and r.jaccard >= 0.75
        assert r.jaccard == pytest.approx(len(sa & sb) / len(sa | sb))
    assert sum(r.doc_id == 8 for r in out) == 2


def test_every_exact_repeat_is_found(spark):
    r = random.Random(11)
    pool = [sentences(700 + k, 52) for k in range(8)]
    rows, has = [], {}
    for i in range(60):
        p = r.choice([None, *range(8)])
        rows.append((i, " ".join([sentences(900 + i, r.randint(0, 80)), pool[p] if p is not None else "", sentences(5000 + i, r.randint(0, 80))])))
        has[i] = p
    out = P.near_duplicate_passages(docs(spark, rows)).collect()
    named = {x for r in out for x in (r.doc_id, r.first_id)}
    shared = {i for i, p in has.items() if p is not None and sum(q == p for q in has.values()) > 1}
    assert named == shared


def test_passages_of_messy_rows(spark):
    out = P.near_duplicate_passages(messy(spark)).collect()
    named = {x for r in out for x in (r.doc_id, r.first_id)}
    assert {1, 2, 6, 7, 9} <= named and not named & {3, 4, 5, 8, 10, 11, 12, 13, 14}
    assert P.near_duplicate_passages(empty(spark)).collect() == []
    assert Words([b"", None], white_table()).n == 0


def test_equal_passages_beside_an_edited_first_one(spark):
    # Document a holds b's passage with words replaced: below the threshold, yet with common window keys.
    r = random.Random(3)
    rows, lost = [], 0
    for g in range(60):
        words = sentences(8000 + g, 52).split()
        edited = list(words)
        for k in r.sample(range(52), 3 + g % 4):
            edited[k] = "edit%d" % k
        for k, passage in enumerate((edited, words, words)):
            rows.append((3 * g + k, " ".join([sentences(10 * g + k + 20000, 40), *passage, sentences(10 * g + k + 30000, 40)])))
    out = {(r.first_id, r.doc_id) for r in P.near_duplicate_passages(docs(spark, rows)).collect()}
    for g in range(60):
        a, b, c = 3 * g, 3 * g + 1, 3 * g + 2
        lost += not ((b, c) in out or {(a, b), (a, c)} <= out)
    assert lost == 0


def _edited_passages(words, edits, groups, seed):
    """Rows in which documents 2g and 2g + 1 hold a passage and its copy with some inner words replaced,
    and the similarity of the two."""
    r = random.Random(seed)
    rows, alike = [], []
    for g in range(groups):
        passage = sentences(seed + g, words).split()
        copy = list(passage)
        for k in r.sample(range(5, words - 5), edits):
            copy[k] = "edit%d" % k
        for k, p in enumerate((passage, copy)):
            rows.append((2 * g + k, " ".join([sentences(seed + 7000 + 2 * g + k, r.randint(0, 60)), *p, sentences(seed + 9000 + 2 * g + k, r.randint(0, 60))])))
        x, y = shingles(" ".join(passage)), shingles(" ".join(copy))
        alike.append(len(x & y) / len(x | y))
    return rows, alike


def test_recall_of_edited_passages(spark):
    rows, due = [], {}
    for n, (words, edits) in enumerate([(52, 1), (55, 1), (60, 1), (60, 2), (66, 1), (66, 2), (120, 2), (120, 3), (400, 8)]):
        some, alike = _edited_passages(words, edits, 40, 100_000 * (n + 1))
        rows += [(100 * n + i, t) for i, t in some]
        due.update({(100 * n + 2 * g, 100 * n + 2 * g + 1): (words, edits) for g, j in enumerate(alike) if j >= 0.76})
    found = {(r.first_id, r.doc_id) for r in P.near_duplicate_passages(docs(spark, rows)).collect()}
    assert len(due) > 250
    for kind in set(due.values()):
        pairs = [p for p, k in due.items() if k == kind]
        assert sum(p in found for p in pairs) >= 0.9 * len(pairs), (kind, len(pairs))
    # Nothing beyond the planted pairs.
    assert all(a // 2 == b // 2 for a, b in found)


def test_every_passage_at_the_threshold_is_linked(spark):
    """Small classes right above the threshold, where three smallest tokens are not enough."""
    rows, due = [], set()
    for n, (words, edits) in enumerate([(52, 1), (60, 1), (66, 2), (120, 3)]):
        some, alike = _edited_passages(words, edits, 150, 900_000 + 10_000 * n)
        rows += [(1000 * n + i, t) for i, t in some]
        due |= {(1000 * n + 2 * g, 1000 * n + 2 * g + 1) for g, j in enumerate(alike) if j >= 0.75}
    found = {(r.first_id, r.doc_id) for r in P.near_duplicate_passages(docs(spark, rows)).collect()}
    assert len(due) > 400 and due <= found and all(a // 2 == b // 2 for a, b in found)


def test_passages_of_words_that_repeat_are_linked(spark):
    """Runs of few different tokens, in which no token has a partner of its own."""
    rows = []
    for n, (period, before, after) in enumerate((p, b, a) for p in (1, 2, 3, 7) for b in (0, 30, 90) for a in (0, 60)):
        line = " ".join(f"p{n}q{i}" for i in range(period)) + " "
        rows += [(2 * n, " ".join([sentences(70_000 + n, 40), line * (150 // period), sentences(71_000 + n, after)])),
                 (2 * n + 1, " ".join([sentences(72_000 + n, before), (line * (90 // period + 1)).split(" ", 1)[-1], sentences(73_000 + n, 20)]))]
    found = {(r.first_id, r.doc_id) for r in P.near_duplicate_passages(docs(spark, rows)).collect()}
    assert {(2 * n, 2 * n + 1) for n in range(24)} <= found and all(a // 2 == b // 2 for a, b in found)


def test_passages_of_a_text_that_repeats_itself(spark):
    part, line = sentences(74_000, 70), sentences(74_001, 20)
    rows = [(1, " ".join([part, sentences(74_002, 30), part])), (2, " ".join([line] * 4 + [sentences(74_003, 30)] + [line] * 4))]
    out = P.near_duplicate_passages(docs(spark, rows)).collect()
    assert {(r.first_id, r.doc_id) for r in out} == {(1, 1), (2, 2)} and all(r.first_end <= r.start for r in out)


def _brute_runs(x, y, least):
    return any(100 * len(set(x[s:e]) & set(y[f:g])) >= P.PERCENT * len(set(x[s:e]) | set(y[f:g]))
               for s in range(len(x)) for e in range(s + least, len(x) + 1) for f in range(len(y)) for g in range(f + least, len(y) + 1))


def test_any_passage_is_that_of_all_runs():
    r, seen = random.Random(9), set()
    for n in range(150):
        x = [r.randrange(4 + n % 30) for _ in range(r.randint(6, 14))]
        y = [v if r.random() < 0.8 else r.randrange(40) for v in x] + [r.randrange(40)] * r.randint(0, 3)
        hit = P.any_passage(np.array(x, np.uint64), np.array(y, np.uint64), P.PERCENT, 6)
        seen.add(hit is not None)
        assert (hit is not None) == _brute_runs(x, y, 6)
        if hit:
            s, e, f, g = hit
            assert min(e - s, g - f) >= 6 and _brute_runs(x[s:e], y[f:g], min(e - s, g - f))
    assert seen == {True, False}


def test_dense_places_are_those_of_all_runs():
    r = np.random.default_rng(4)
    for _ in range(60):
        cost, segment = r.integers(-2, 4, 40), np.sort(r.integers(0, 3, 40))
        segment = np.unique(segment, return_inverse=True)[1]
        slack, least = int(r.integers(0, 4)), int(r.integers(1, 9))
        want = np.zeros(40, bool)
        for i in range(40):
            for j in range(i + least, 41):
                if segment[i] == segment[j - 1] and cost[i:j].sum() <= slack:
                    want[i:j] = True
        assert (P.dense(cost, segment, slack, least) == want).all()


def test_regions_with_a_common_passage_share_keys():
    """With repeated words as well, however often the tokens stand elsewhere."""
    r, n = random.Random(6), 0
    for seed in range(120):
        words = [f"w{r.randrange(4 + 3 * seed)}" for _ in range(r.randint(50, 70))]
        copy = list(words)
        for k in r.sample(range(len(words)), r.randint(0, 2)):
            copy[k] = "new%d" % k
        a, b = P.tokens([" ".join([sentences(seed, r.randint(0, 9)), *p, sentences(seed + 500 + i, r.randint(0, 9))]).encode() for i, p in enumerate((words, copy))])
        if not P.any_passage(a.hash, b.hash):
            continue
        n += 1
        [possible] = P._possible([a.hash], [b.hash])
        assert possible is not None
        times = {int(h): r.choice([2, 3, 50]) if h in a.hash and h in b.hash else r.choice([1, 2, 3, 50]) for h in np.concatenate((a.hash, b.hash))}
        weights = []
        for t in (a, b):
            keys, low = P.region_keys(t.hash, np.array([times[int(h)] for h in t.hash]), np.zeros(len(t.hash), np.int64))
            w = {}
            for h, l in zip(t.hash[keys].tolist(), low[keys].tolist()):
                w[h] = max(w.get(h, 1), P.SHARED if l else 1)
            weights.append(w)
        assert sum(min(w, weights[1][h]) for h, w in weights[0].items() if h in weights[1]) >= P.SHARED
    assert n > 60


def test_passages_against_all_runs():
    """The longest run of either text that begins and ends with a shared token and is similar enough."""
    r = random.Random(5)
    for seed in range(40):
        words = r.randint(52, 75)
        passage = sentences(60_000 + seed, words).split()
        copy = list(passage)
        for k in r.sample(range(words), r.randint(0, 3)):
            copy[k:k + 1] = r.choice([[], ["new%d" % k], ["new%d" % k, "more%d" % k]])
        a, b = P.tokens([" ".join([sentences(61_000 + seed, 20), *p, sentences(62_000 + seed + 100 * i, 20)]).encode() for i, p in enumerate((passage, copy))])
        where = {h: i for i, h in enumerate(a.hash.tolist())}
        at = [where.get(h) for h in b.hash.tolist()]
        best = 0
        for s in range(len(at)):
            for e in range(s + P.MIN_TOKENS, len(at) + 1):
                if at[s] is None or at[e - 1] is None or at[e - 1] - at[s] + 1 < P.MIN_TOKENS:
                    continue
                x, y = set(a.hash[at[s]:at[e - 1] + 1].tolist()), set(b.hash[s:e].tolist())
                if 100 * len(x & y) >= P.PERCENT * len(x | y):
                    best = max(best, e - s)
        got = P.passages(a, b)
        sizes = [int(np.sum((b.start >= p[2]) & (b.end <= p[3]))) for p in got]
        assert (max(sizes, default=0) >= P.MIN_TOKENS) == (best > 0)
        assert max(sizes, default=0) >= 0.9 * best


def test_shingles_of_a_few_words_do_not_depend_on_the_batch():
    few = [b"a", b"a b", b"a b c"]
    for t in few:
        alone = Words([t], white_table()).shingles(5)[1]
        w = Words([*few, b"one two three four five six", t], white_table())
        at, h = w.shingles(5)
        assert alone.tolist() == h[w.text[at] == 4].tolist()


def test_equal_texts_repeat_the_first_as_a_whole(spark):
    body = sentences(88, 60)
    rows = [(5, f" \n{body}\t"), (3, f" \n{body}\t"), (9, f" \n{body}\t"), (2, "a b c"), (4, "a b c"), (7, body)]
    out = {(r.first_id, r.first_start, r.first_end, r.doc_id, r.start, r.end) for r in P.near_duplicate_passages(docs(spark, rows)).collect()}
    n = len(body.encode())
    assert out == {(3, 2, 2 + n, 5, 2, 2 + n), (3, 2, 2 + n, 9, 2, 2 + n), (3, 2, 2 + n, 7, 0, n)}


def test_common_line_in_different_texts_ends(spark):
    line = sentences(77, 12)
    rows = [(k, " ".join([sentences(40000 + k, 60), line, sentences(50000 + k, 60)])) for k in range(150)]
    assert P.near_duplicate_passages(docs(spark, rows)).collect() == []


def test_an_id_with_an_unrelated_second_text_keeps_its_links(spark):
    """Sixty documents below the threshold around document 100, whose near copy is 101: with or without
    another text of document 100, the two belong together."""
    r = random.Random(7)
    words = [f"w{k}" for k in range(110)]

    def edited(n, tag):
        out = list(words)
        for k in r.sample(range(5, 105), n):
            out[k] = f"{tag}x{k}"
        return " ".join(out)

    rows = [(100, " ".join(words)), (101, edited(2, "near"))] + [(k, edited(4, f"t{k}")) for k in range(1, 61)]
    for extra in ([], [(100, sentences(11, 400))]):
        got = {x.doc_id: x.component_id for x in N.near_duplicates(docs(spark, rows + extra)).collect()}
        sets = {}
        for i, t in rows + extra:
            w = t.split()
            sets.setdefault(i, []).append({tuple(w[k:k + 5]) for k in range(len(w) - 4)})
        parent = {i: i for i in sets}

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i
        ids = sorted(sets)
        for a in ids:
            for b in ids:
                if a < b and any(100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                    p, q = sorted((find(a), find(b)))
                    parent[q] = p
        want = {i: find(i) for i in ids}
        assert got == want and want[100] == want[101]


def test_spans_of_tokens_are_packed_whole():
    for text in ["one", "a b  c", " ".join(f"w{k}" + " " * (k % 4) for k in range(300)), "x" * 70_000 + " y" * 90]:
        [t] = P.tokens([text.encode()])
        start, end = P._unpack(P._pack(t.start, t.end))
        assert start.tolist() == t.start.tolist() and end.tolist() == t.end.tolist()


def test_regions_that_meet_lie_in_few_cells(spark):
    # 300 groups of 4 regions each, and one group that fills several parts.
    groups = [range(10 * g, 10 * g + 4) for g in range(300)]
    pairs = [(a, b) for g in groups for a in g for b in g if a < b] + [(5000, k) for k in range(5001, 5400)]
    ids = sorted({n for p in pairs for n in p})
    regions = spark.createDataFrame([(n, bytearray(800)) for n in ids], "n bigint, tok binary")
    size, parts = 800 * len(ids), 64
    part = {r.n: r.part for r in P._dealt_to_parts(spark.createDataFrame(pairs, "x bigint, y bigint"), regions, size, parts).collect()}
    assert sorted(part) == ids and set(part.values()) <= set(range(parts))
    assert all(len({part[n] for n in g}) == 1 for g in groups)
    assert len({part[n] for n in range(5000, 5400)}) > 5


def test_shuffle_files_go_with_the_query_that_made_them(spark):
    import time

    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    here = lambda: {f for f in (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())) if f.startswith("shuffle_")}
    before, known = here(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    out = Scratch(spark, "tidy", tidy=True).put("t", spark.range(1000).repartition(7, "id"))
    until = time.time() + 20
    while here() - before and time.time() < until:
        time.sleep(0.2)
    assert not here() - before and out.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == known


def test_search_of_texts_that_repeat_few_words_ends():
    """Lines just below the threshold, many times over: all their runs have few sets of words."""
    import time

    began = time.process_time()
    for words, times in ((33, 70), (60, 40)):
        line = sentences(92_000 + words, words).split()
        other = list(line)
        for k in range(3, words - 4, 30):
            other[k] = "other%d" % k
        a, b = P.tokens([" ".join(x * times).encode() for x in (line, other)])
        hit = P.any_passage(a.hash, b.hash)
        sa, sb = set(a.hash.tolist()), set(b.hash.tolist())
        assert words != 33 or (hit is None and 100 * len(sa & sb) < P.PERCENT * len(sa | sb))
        if hit:
            x, y = set(a.hash[hit[0]:hit[1]].tolist()), set(b.hash[hit[2]:hit[3]].tolist())
            assert 100 * len(x & y) >= P.PERCENT * len(x | y)
    assert time.process_time() - began < 20


def test_any_passage_of_a_long_and_a_short_text():
    a = np.arange(3000, dtype=np.uint64)
    b = np.concatenate((np.arange(10_000, 10_400), np.arange(1000, 1060))).astype(np.uint64)
    s, e, f, g = P.any_passage(a, b)
    x, y = set(a[s:e].tolist()), set(b[f:g].tolist())
    assert min(e - s, g - f) >= P.MIN_TOKENS and 100 * len(x & y) >= P.PERCENT * len(x | y)
    assert P.any_passage(a, b[:400]) is None


def test_few_sets_of_runs_give_what_all_runs_give():
    r = random.Random(19)
    for n in range(150):
        x = [r.randrange(2 + n % 12) for _ in range(r.randint(6, 16))]
        y = [v if r.random() < 0.8 else r.randrange(40) for v in x] + [r.randrange(40)] * r.randint(0, 3)
        a, b = (P._longest_of_each_set(np.array(z), 6) for z in (x, y))
        [hit] = P._few(a, b, P.PERCENT) or [None]
        assert (hit is not None) == _brute_runs(x, y, 6)
        if hit:
            s, e, f, g = hit
            assert min(e - s, g - f) >= 6 and _brute_runs(x[s:e], y[f:g], min(e - s, g - f))


def test_ranges_of_longest_runs_lose_none(monkeypatch):
    monkeypatch.setattr(P, "MANY_RANGES", 0)
    monkeypatch.setattr(P, "FEW_PAIRS", 0)
    r = random.Random(29)
    for n in range(100):
        x = [r.randrange(2 + n % 20) for _ in range(r.randint(6, 14))]
        y = [v if r.random() < 0.8 else r.randrange(40) for v in x]
        assert (P.any_passage(np.array(x, np.uint64), np.array(y, np.uint64), P.PERCENT, 6) is not None) == _brute_runs(x, y, 6)


def test_further_passages_of_a_linked_pair_are_found(spark):
    """Documents b and c of a group repeat a and, beside that, share an edited passage."""
    rows, due = [], set()
    for g in range(5625, 5645):
        common, passage = sentences(700_000 + g, 60), sentences(800_000 + g, 60).split()
        copy, r = list(passage), random.Random(g)
        k = r.randrange(8, 52)
        copy[k] = f"edit{k}"
        if r.random() < 0.5:
            copy[k + 1] = f"edit{k + 1}"
        rows += [(3 * g, common), (3 * g + 1, " ".join([common, *passage])), (3 * g + 2, " ".join([common, *copy]))]
        x, y = shingles(" ".join(passage)), shingles(" ".join(copy))
        due |= {(3 * g + 1, 3 * g + 2)} if 100 * len(x & y) >= 75 * len(x | y) else set()
    found = {(r.first_id, r.doc_id) for r in P.near_duplicate_passages(docs(spark, rows)).collect()}
    assert len(due) > 10 and due <= found and all(a // 3 == b // 3 for a, b in found)


def test_all_passages_of_a_pair_are_found():
    """One passage that the longest runs show, and one of words that repeat, which they do not."""
    shared, n = sentences(93_000, 80), 0
    for period in (1, 2, 3, 5, 7, 11, 13):
        line = " ".join(f"p{period}q{i}" for i in range(period)) + " "
        a, b = P.tokens([" ".join([shared, sentences(93_100 + k, 60), line * (size // period), sentences(93_200 + k, 60)]).encode() for k, size in enumerate((150, 90))])
        plain = P.passages(a, b)
        n += len(plain) == 1
        got = P._all_passages(a, b, P._common(a, b))
        assert len(got) >= 2
        for a0, a1, b0, b1, both, either in got:
            x, y = ({int(h) for h, s, e in zip(t.hash, t.start, t.end) if s >= i and e <= j} for t, i, j in ((a, a0, a1), (b, b0, b1)))
            assert len(x & y) == both and len(x | y) == either and 100 * both >= P.PERCENT * either
    assert n
