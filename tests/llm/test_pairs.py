"""Alignment, spelling variants and the n-gram join against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sitefold.llm import align, common as C, ngram_join, spelling

from .conftest import SCHEMA, prose

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, 7, "x", "y", "z") for i, t in rows], SCHEMA).withColumn("node", F.lit("q")).withColumn("a.b", F.lit(1))


# ---------------------------------------------------------------- 11 alignment


def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_file(C.tokenizer_path(A_FILE))
    byte_level.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=C.tokenizer_path(B_FILE))
    letters = {chr(c): b for b, c in C.BYTES.items()}
    spelled = lambda name: bytes(letters.get(x, ord(x)) for x in name)
    docs = []
    for doc, text in rows:
        a = byte_level.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        sides = []
        for ids, of in ((a, lambda k: spelled(byte_level.id_to_token(k))), (b, lambda k: bytes([int(pieces.id_to_piece(k)[3:5], 16)]) if pieces.is_byte(k) else pieces.id_to_piece(k).replace("▁", " ").encode())):
            at, spans = 0, []
            for k in ids:
                spans.append((at, at + len(of(k)), k))
                at += len(of(k))
            sides.append((spans, b"".join(of(k) for k in ids)))
        if text and any(raw != (" " + text).encode() for _, raw in sides):
            sides = [([], b""), ([], b"")]
        (sa, _), (sb, _) = sides
        ends = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
        groups, lo = [], 0
        for hi in ends:
            groups.append("|".join(",".join(str(k) for s, _, k in side if lo <= s < hi) for side in (sa, sb)))
            lo = hi
        links = Counter((x, y) for s, e, x in sa for u, v, y in sb if s < v and u < e)
        docs.append((doc, len(sa), len(sb), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if sa else ""))
    count = Counter(pair for d in docs for pair in d[4])
    top = defaultdict(int)
    for (x, _), c in count.items():
        top[x] = max(top[x], c)
    return sorted(((d, na, nb, g, sum(k.values()), sum(n for p, n in k.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in k.items()), sha)
                   for d, na, nb, g, k, sha in docs), key=str)


ODD = ["", None, "a", " ", "  \n", "▁", "x ▁ y", "<s> </s> <|endoftext|> <0x41>", "日本語のテキスト 漢字", "é́ ﬁ　x", "tab\tand\r\nline\n\n  end  ", "x" * 300, "😀😀 ok", "don't we'll ();\r\n}\r"]


@pytest.mark.parametrize("head", [1 << 20, 20, 0])
def test_alignment_agrees_with_plain_python(spark, head):
    r = random.Random(3)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(50, "twice the same"), (50, "twice the same"), (None, "no id here"), (60, prose(4, 3000))]
    rows += [(100 + k, "".join(r.choice([" ", "the", "Über", "12", "\n", "()", "ation", "日", "  ", "s"]) for _ in range(r.randint(1, 60)))) for k in range(60)]
    got = align.align(table(spark, rows).repartition(4), C.tokenizer_path(A_FILE), C.tokenizer_path(B_FILE), head_pairs=head).collect()
    assert sorted((tuple(x) for x in got), key=str) == plain_alignment(rows)


def test_alignment_of_an_empty_table(spark):
    got = align.align(table(spark, [(1, "x")]).limit(0), C.tokenizer_path(A_FILE), C.tokenizer_path(B_FILE))
    assert got.count() == 0 and got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


# ---------------------------------------------------------------- 12 spelling variants


def plain_words(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


def near(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    if len(x) == len(y):
        return sum(p != q for p, q in zip(x, y, strict=True)) == 1
    s, t = sorted((x, y), key=len)
    return any(t[:i] + t[i + 1 :] == s for i in range(len(t)))


def plain_variants(rows):
    words = plain_words(rows)
    close = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(close[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def variants_text(seed, n=2500):
    r = random.Random(seed)
    base = ["spelling", "variant", "Grouping", "aaaaa", "aaaaaa", "aaaaaaa", "élèves", "élevés", "colour", "color", "colours", "ÀÉÎÕÜ", "abcde", "abcdf", "abxde", "bbcde"]
    out = []
    for _ in range(n):
        w = r.choice(base)
        if r.random() < 0.5:
            at = r.randrange(len(w))
            w = w[:at] + r.choice(["", "a", "é", w[at] + "b"]) + w[at + 1 :]
        out.append(w)
    return r.choice([" ", "1", ", "]).join(out)


@pytest.mark.parametrize("partition", [20_000, 2])
def test_variants_agree_with_plain_python(spark, partition):
    rows = [(k, variants_text(k)) for k in range(6)] + [(7, None), (8, ""), (None, variants_text(9)), (10, "longer" * 60 + " x " + "longer" * 60 + "s"), (10, "longer" * 60 + " x " + "longer" * 60 + "s"), (11, "longer" * 60 + " x " + "longer" * 60 + "s")]
    got = spelling.group(table(spark, rows).repartition(3), partition=partition).collect()
    want = plain_variants(rows)
    assert sorted(tuple(x) for x in got) == want
    assert any(w[1] for w in want) and any(w[1] and w[2] != w[1] for w in want) and any(len(w[0]) > 300 and w[4] for w in want)


def test_variants_of_an_empty_table(spark):
    assert spelling.group(table(spark, [(1, "x")]).limit(0)).count() == 0


def test_a_hot_partition_is_parted(spark):
    # Words that share a long beginning would all start from one state.
    r = random.Random(2)
    words = {"common" + "".join(r.choice("abcde") for _ in range(5)) for _ in range(400)}
    rows = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n bigint")
    parts = spelling.partitions(rows, 50)
    assert parts.groupBy("key").count().agg(F.max("count")).first()[0] <= 50
    got = {(x["word"], x["near"]) for x in spelling.near_pairs(rows, 50).collect()}
    assert got == {(x, y) for x in words for y in words if near(x, y)}


def test_the_acceptor_is_minimal_and_composes():
    words = ["tap", "taps", "top", "tops", "stop", "stops"]
    m = spelling.Acceptor(words)
    assert len(m.arcs) == 7  # before and after s, t, st, a or o, p and s: equal ends are one state
    assert {frozenset(p) for p in m.pairs()} == {frozenset((x, y)) for x in words for y in words if near(x, y)}


# ---------------------------------------------------------------- 13 n-gram join


def plain_join(rows, k=3, percent=90):
    sets = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())
        sets[doc] = {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, x in enumerate(ids):
        for y in ids[n + 1 :]:
            both = len(sets[x] & sets[y])
            if both and 100 * both >= percent * len(sets[x] | sets[y]):
                p, q = sorted((find(x), find(y)))
                root[q] = p
    return sorted((d, len(s), find(d)) for d, s in sets.items())


def edited(text, seed, n):
    r = random.Random(seed)
    words = text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return " ".join(words)


def copies():
    """Families at and about the threshold: their links form chains, and most pairs are just below it."""
    out, doc = [], 0
    for size in (6, 12, 20, 21, 40, 90, 300, 1200):
        text = prose(size, size)
        for k in range(14):
            edits = max(1, size * 95 // 6000 + k % 3) if size >= 20 else k % 2
            out.append((doc, edited(text if k % 4 else out[-1][1] if k else text, 31 * size + k, edits)))
            doc += 1
    return out + [(900, None), (901, ""), (902, "one"), (903, "ONE"), (904, "one two"), (905, "  \n"), (906, prose(77, 40)), (907, prose(77, 40).upper().lower())]


@pytest.mark.parametrize("block", [2048, 5])
def test_join_agrees_with_all_pairs(spark, block):
    rows = copies()
    got = ngram_join.cluster(table(spark, rows).repartition(5), block=block).collect()
    assert sorted(tuple(x) for x in got) == plain_join(rows)


def test_join_takes_rows_without_an_id_or_with_several_texts(spark):
    rows = [(1, prose(1, 50)), (1, prose(2, 50)), (2, prose(2, 50)), (2, prose(2, 50)), (None, prose(1, 50)), (3, prose(1, 50))]
    got = sorted((tuple(x) for x in ngram_join.cluster(table(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 48, 1), (1, 48, 1), (2, 48, 1), (2, 48, 1), (None, 48, None), (3, 48, 1)], key=str)
    assert ngram_join.cluster(table(spark, rows).limit(0)).count() == 0


def test_linked_sets_share_a_branch():
    import numpy as np

    r = np.random.default_rng(4)
    for n in [2, 5, 9, 10, 11, 17, 38, 57, 86, 120, 400, 1500, 12_000]:
        for _ in range(6):
            whole = np.unique(r.integers(0, 2**63, 2 * n, np.uint64))[:n]
            both = -(-9 * n // 10)  # of n, so many are common: the least that links a set with a subset of it
            part = np.sort(r.choice(whole, both, replace=False))
            keys = []
            for s in (whole, part):
                c = ngram_join.size_class(len(s))
                own = ngram_join.branch_keys(s, c, 90)
                if 100 * len(s) >= 90 * (ngram_join.class_bound(c) + 1):
                    own += ngram_join.branch_keys(s, c + 1, 90)
                keys.append(set(np.concatenate(own).tolist()) if own else set())
            if 100 * both >= 90 * n and both < n:
                assert keys[0] & keys[1], n


def test_tree_keeps_every_pair_that_the_bound_allows():
    import numpy as np

    r = np.random.default_rng(1)
    base = r.poisson(4, (6, 32))
    points = np.concatenate([b + r.poisson(0.3, (70, 32)) for b in base])
    sizes = points.sum(1)
    tree = ngram_join.Tree(points, sizes, leaf=8)
    got = [(x, y) for i, j in ngram_join.tree_pairs(tree, tree, 90, True) for x, y in zip(i.tolist(), j.tolist(), strict=True)]
    want = {frozenset((x, y)) for x in range(len(points)) for y in range(x)
            if 190 * np.minimum(points[x], points[y]).sum() >= 90 * (sizes[x] + sizes[y]) and 10 * min(sizes[x], sizes[y]) >= 9 * max(sizes[x], sizes[y])}
    assert len(got) == len({frozenset(p) for p in got}) and {frozenset(p) for p in got} == want and 0 < len(want) < 0.5 * len(points) ** 2 / 2


def test_sketches_bound_what_sets_differ_in():
    import numpy as np

    from sitefold.llm import sets

    r = np.random.default_rng(7)
    for n, m, shared in [(1, 1, 1), (3, 4, 3), (40, 50, 38), (200, 260, 198), (900, 900, 700), (5000, 6000, 4900), (70, 70, 50)]:
        whole = np.unique(r.integers(0, 2**63, 2 * (n + m), np.uint64))[: n + m - shared]
        r.shuffle(whole)
        x, y = np.sort(whole[:n]), np.sort(whole[n - shared :])
        assert len(x) == n and len(y) == m and len(np.intersect1d(x, y)) == shared
        for percent in (75, 90):
            linked = 100 * shared >= percent * (n + m - shared)
            one = sets.unlike_sets(n, sets.sketch_of(x), m, sets.sketch_of(y), percent)
            words = sets.sketches([(n, sets.sketch_of(x)), (m, sets.sketch_of(y))])
            many = sets.may_link(words[:1], np.array([n]), words[1:], np.array([m]), percent)[0, 0]
            assert (one is not None) == many and (many or not linked)
            assert one is None or one <= n + m - 2 * shared


def test_only_cut_branches_are_searched_again(spark):
    import numpy as np

    from sitefold.llm import sets

    x, y = np.triu_indices(30, 1)
    parts = [(x, y, np.ones(len(x)))]
    (a, b, _, more), = sets.given(parts, 30, True)
    assert more and 0 < len(a) < len(x)
    (a, b, _, more), = sets.given([(x[:200], y[:200], np.ones(200))], 30, True)
    assert not more and len(a) == 200
    (a, b, _, more), = sets.given(parts, 30, False)
    assert not more and len(a) == len(x)

    texts = spark.createDataFrame([(n, prose(n // 2, 40)) for n in range(8)], "node long, text string")
    members = spark.createDataFrame([(key, n) for n in range(8) for key in (n // 2, 10 + n // 4)], "key long, node long")
    none = spark.createDataFrame([], "a long, b long")
    asked = []

    def search(placed, best):
        asked.append((best, sorted({r.key for r in placed.collect()})))
        left, right = placed.select("key", F.col("node").alias("a"), F.col("c").alias("ca")), placed.select("key", F.col("node").alias("b"), F.col("c").alias("cb"))
        cut = F.when(F.col("key").isin(10) & F.lit(best), F.col("key"))
        return left.join(right, "key").where("a < b and ca <> cb").select("a", "b", F.lit(0.0).alias("unlike"), cut.alias("cut"))

    got = sets.settled(members, spark.createDataFrame([], "id long, component long"), none, texts, search, 3, 90)
    assert asked == [(True, [0, 1, 2, 3, 10, 11]), (True, [10]), (False, [10])]
    assert {tuple(r) for r in got.collect()} == {(n, n // 2 * 2) for n in range(8)}
