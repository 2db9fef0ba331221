"""Line dedup against all pairs of lines."""

import random
import re
import time
from collections import Counter
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cadence.llm import line_dedup as L
from cadence.llm.queries import QUERIES
from cadence.session import checkpoint_dir
from tests.llm.fixtures import SF, corpus, frame, stored


def norm(line):
    return [w for w in re.split(r"[\W_]+", line.lower()) if w]


def simhash(words):
    hashes = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(texts):
    """Texts without lines that are not the first of their group."""
    first, order = {}, []
    for t in texts:
        for line in (t or "").split("\n"):
            words = tuple(norm(line))
            if words and words not in first:
                first[words] = len(order)
                order.append(words)
    sims = [simhash(w) for w in order]
    label = list(range(len(order)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    bags = [Counter(w) for w in order]
    for i, j in combinations(range(len(order)), 2):
        allowed = int(max(len(order[i]), len(order[j])) * (1 - L.SIMILARITY) + 1e-9)
        if abs(len(order[i]) - len(order[j])) > allowed:
            continue        # so many edits at least; likewise below
        if max(len(order[i]), len(order[j])) - (bags[i] & bags[j]).total() > allowed:
            continue
        if bin(sims[i] ^ sims[j]).count("1") <= L.MAX_BITS:
            if edits(order[i], order[j]) <= allowed:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    seen, out = set(), []
    for t in texts:
        lines = []
        for line in (t or "").split("\n"):
            words = tuple(norm(line))
            group = root(first[words]) if words else None
            if group is None or group not in seen:
                lines.append(line)
            if group is not None:
                seen.add(group)
        out.append(None if t is None else "\n".join(lines))
    return out


def lines_with_variants(seed=4):
    """Groups of long lines that differ by a word or two, chains included."""
    rng = random.Random(seed)
    texts = []
    for g in range(6):
        base = [f"g{g}v{rng.randrange(200)}" for _ in range(120)]
        for k in range(25):
            words = list(base)
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"new{g}n{k}"
            if k % 5 == 0:
                base = words
            texts.append(f"own line {g} {k}\n{' '.join(words)}.")
    return texts


def test_against_all_pairs(spark, tmp_dir):
    texts = corpus() + lines_with_variants() + ["own LINE 0, 0!\n---\n\n---\nown line 0 0", "---"]
    docs = stored(spark, texts, tmp_dir)
    # one file and task order: table order is doc_id order
    docs = docs.coalesce(1)
    path = f"{tmp_dir}/one"
    docs.orderBy("doc_id").coalesce(1).write.parquet(path)
    docs = spark.read.schema(docs.schema).parquet(path)
    found = L.dedup_lines(docs, counts=("n_lines", "n_removed"))
    assert found.columns == [*docs.columns, "n_lines", "n_removed"]
    rows = {r["doc_id"]: r for r in found.collect()}
    want = brute(texts)
    assert [rows[i]["text"] for i in range(len(texts))] == want
    for i, t in enumerate(texts):
        n = len(t.split("\n")) if t is not None else 0
        left = len(want[i].split("\n")) if want[i] else 0
        assert rows[i]["n_lines"] == n
        assert rows[i]["n_removed"] == n - left or not want[i]


def test_lanes_hold_long_lines(spark):
    words = [f"w{k % 7}" for k in range(200_000)]
    line = spark.createDataFrame([(1, 5, " ".join(words))], "o long, h long, norm string")
    got = L._simhashes(line).first()
    assert (got["o"], got["h"], got["sim"] % (1 << 64)) == (1, 5, simhash(words))


def test_query_and_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id")
    found = {r["doc_id"]: r for r in QUERIES["op2_line_dedup"](spark, SF).collect()}
    want = brute([r["text"] for r in docs.collect()])
    assert len(found) == len(want)
    same = sum(found[i]["text"] == t for i, t in enumerate(want))
    kept = sum(len(r["text"].split("\n")) for r in found.values())
    assert same >= 0.99 * len(want) and kept == sum(len(t.split("\n")) for t in want)
    assert L.dedup_lines(frame(spark, [])).count() == 0


def test_recall_of_changed_lines(spark, tmp_dir):
    """Lines at the edge of the edit similarity are linked, just past it not."""
    rng = random.Random(9)
    texts, want = [], []
    for size in (4, 5, 9, 10, 14, 27, 100):
        for edits_made in sorted({0, 1, size // 10, size // 5, size // 5 + 1}):
            for kind in ("swap", "drop", "add"):
                tag = f"s{size}e{edits_made}{kind}"
                base = [f"{tag}w{rng.randrange(10**6)}" for _ in range(size)]
                places = rng.sample(range(size), edits_made)
                other = [([] if kind == "drop" else [f"new{i}{tag}"] if kind == "swap"
                          else [w, f"new{i}{tag}"]) if i in places else [w]
                         for i, w in enumerate(base)]
                other = [w for ws in other for w in ws]
                texts.append(" ".join(base) + "\n" + " ".join(other))
                allowed = int(max(len(base), len(other)) * (1 - L.SIMILARITY) + 1e-9)
                want.append(int(edits(base, other) <= allowed))
    rows = L.dedup_lines(stored(spark, texts, tmp_dir), counts=("n_lines", "n_removed")).collect()
    got = {r["doc_id"]: r["n_removed"] for r in rows}
    assert [got[i] for i in range(len(texts))] == want
    assert 0 < sum(want) < len(want)


def crowded_lines():
    """Lines that all share their longest word pair, and eight similar ones
    whose other long pairs are edited: that block is the only one of both."""
    def line(tag, x, y):
        own = [f"{tag}{k}" for k in range(6)]
        return " ".join(["commonwordnumberone", "commonwordnumbertwo", own[0], own[1],
                         f"{x}{'l' * 20}{tag}", own[2], own[3], f"{y}{'l' * 20}{tag}", *own[4:]])

    return ([line(f"f{k}f", "x", "y") for k in range(150)]
            + [line(f"s{k}s", x, y) for k in range(8) for x, y in ("xy", "vw")])


@pytest.mark.parametrize("sample, hot", [(64, 32), (2, 4)])
def test_links_in_a_large_block(spark, tmp_dir, monkeypatch, sample, hot):
    monkeypatch.setattr(L, "SAMPLE", sample)
    monkeypatch.setattr(L, "HOT", hot)
    monkeypatch.setattr(L, "CHUNK", 16, raising=False)
    texts = crowded_lines()
    docs = stored(spark, texts, tmp_dir)
    path = f"{tmp_dir}/one"
    docs.orderBy("doc_id").coalesce(1).write.parquet(path)
    docs = spark.read.schema(docs.schema).parquet(path)
    rows = {r["doc_id"]: r["text"] for r in L.dedup_lines(docs).collect()}
    assert [rows[i] for i in range(len(texts))] == brute(texts)
    assert sum(t == "" for t in rows.values()) == 8


def test_line_stage_of_the_pipeline(spark, tmp_dir):
    """The pipeline's stage loses no link of a large block either."""
    docs = stored(spark, crowded_lines(), tmp_dir)
    left = corpus_pipeline.line_stage(spark, docs, SF).where("text <> ''").count()
    assert left == len(crowded_lines()) - 8


def long_crowded_lines(of=120):
    """Different long lines that share a piece, and so a block, and ten of
    its rarest words; every 20th has a copy with ten words edited."""
    shared = [f"sharedlongword{k}{'x' * 20}" for k in range(10)]
    lines = []
    for k in range(of):
        own = [f"w{k}n{i}" for i in range(110)]
        lines.append(" ".join(shared + own))
        if k % 20 == 0:
            lines.append(" ".join(shared + [f"e{w}" if i % 11 == 5 else w
                                            for i, w in enumerate(own)]))
    return lines


def test_few_candidates_of_long_lines(spark, tmp_dir, monkeypatch):
    """Long lines whose 48 bits are full are told apart before their texts are
    fetched; their links stay."""
    made, real = [], L._verified

    def counted(pairs, classes):
        made.append(pairs.count())
        return real(pairs, classes)

    monkeypatch.setattr(L, "_verified", counted)
    monkeypatch.setattr(L, "PAIR_LIMIT", 8)
    texts = long_crowded_lines()
    left = L.dedup_lines(stored(spark, texts, tmp_dir)).where("text <> ''").count()
    assert left == 120
    assert made[-1] <= len(texts)


def test_wide_parity_keeps_similar_lines(spark):
    rng = random.Random(5)
    pairs = []
    for n in (25, 40, 99, 300):
        for kind in range(6):
            a = [f"w{rng.randrange(400)}" for _ in range(n)]
            b = list(a)
            for _ in range(n // 5):
                at = rng.randrange(len(b))
                b[at:at + 1] = ([f"v{rng.randrange(10**6)}"], [], [b[at], "in"])[kind % 3]
            pairs.append((a, b))
    classes = spark.createDataFrame(
        [(2 * i + j, " ".join(w)) for i, p in enumerate(pairs) for j, w in enumerate(p)],
        "h long, norm string")
    words = F.split("norm", " ")
    shape = F.shiftleft(F.size(words).cast("long"), L._SIGNS).bitwiseOR(
        L._parity(F.transform(words, lambda w: F.xxhash64(w))))
    rows = L._with_wide(classes.withColumn("shape", shape), classes)

    def side(x, parity):
        return rows.where(F.col("h") % 2 == parity).select(
            F.floor(F.col("h") / 2).alias("i"), F.col("shape").alias(f"s{x}"),
            *(F.col(f"p{k}").alias(f"p{k}{x}") for k in range(L.WIDE)))

    both = side("a", 0).crossJoin(side("b", 1).withColumnRenamed("i", "j"))
    found = both.where(L._maybe_similar("sa", "sb") & L._maybe_similar_wide("a", "b"))
    near = [i for i, (a, b) in enumerate(pairs)
            if edits(a, b) <= int(max(len(a), len(b)) * (1 - L.SIMILARITY) + 1e-9)]
    got = {(r["i"], r["j"]) for r in found.select("i", "j").collect()}
    assert len(near) > 12 and {(i, i) for i in near} <= got
    assert all(i == j for i, j in got if len(pairs[i][0]) < 300)


@pytest.mark.parametrize("limit", [2, 10**9])
def test_groups_do_not_depend_on_the_limit(spark, tmp_dir, monkeypatch, limit):
    """The limit chooses the way only: two classes or all compared at once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        frame(spark, crowded_lines() + long_crowded_lines()).select(
            (F.col("doc_id") + 10**6).alias("doc_id"), "text"))
    docs.orderBy("doc_id").coalesce(1).write.parquet(f"{tmp_dir}/one")
    docs = spark.read.parquet(f"{tmp_dir}/one")
    want = {tuple(r) for r in L.dedup_lines(docs).collect()}
    monkeypatch.setattr(L, "PAIR_LIMIT", limit)
    assert {tuple(r) for r in L.dedup_lines(docs).collect()} == want


def test_work_tables_are_removed(spark, tmp_dir):
    """Only the places of the removed lines stay, which the result reads."""
    fs = spark._jvm.org.apache.hadoop.fs
    folder = fs.Path(checkpoint_dir(spark))

    def tables():
        return {f.getPath().getName() for f in folder.getFileSystem(
            spark._jsc.hadoopConfiguration()).listStatus(folder)}

    docs = stored(spark, crowded_lines(), tmp_dir)
    numbered = L.with_row_id(docs, "rid")       # stores its file numbers
    numbered.count()
    before = tables()
    left = L.dedup_lines(docs)
    assert len(tables() - before) <= 2
    assert left.where("text <> ''").count() == len(crowded_lines()) - 8


def test_shuffle_files_are_removed(spark):
    """A work table leaves no shuffle files behind once it is written."""
    disk = spark._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size())
                if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    made = L.materialise(spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).count())
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert made.count() == 97


def test_pairs_told_apart_before_their_texts(spark):
    lines = [" ".join(f"w{k}n{i}" for i in range(60)) for k in range(4)]
    lines.append(" ".join(["new", *lines[0].split()[1:]]))
    lines += ["one two three four five", "one two three four other"]
    classes = spark.createDataFrame(enumerate(lines), "h long, norm string")
    pairs = spark.createDataFrame([(0, 1), (0, 4), (2, 3), (5, 6), (0, 5)], "a long, b long")
    found = {tuple(r) for r in L._wide_alike(pairs, classes).collect()}
    # short lines have no wide parity: their pairs stay
    assert found == {(0, 4), (5, 6), (0, 5)}


def test_pieces_of_edited_lines(spark):
    """Lines at the edge of the edit similarity share a piece, and long ones
    do not have more pieces for it."""
    rng = random.Random(6)
    vocabulary = [f"{'abcdefgh'[k % 8] * (1 + k % 9)}{k}" for k in range(5000)]
    lines = []
    for n in (40, 100):
        for _ in range(200):
            a = [rng.choice(vocabulary) for _ in range(n)]
            b = list(a)
            for k in range(n // 5):
                at = rng.randrange(len(b))
                b[at:at + 1] = ([rng.choice(vocabulary)], [], [b[at], rng.choice(vocabulary)])[k % 3]
            lines += [a, b]
    classes = spark.createDataFrame(
        [(i, " ".join(w)) for i, w in enumerate(lines)], "h long, norm string")
    keys = {i: set() for i in range(len(lines))}
    for r in L._blocks(classes).collect():
        keys[r["h"]].add(r["key"])
    shared = [bool(keys[i] & keys[i + 1]) for i in range(0, len(lines), 2)]
    assert sum(shared[:200]) >= 186 and sum(shared[200:]) >= 198
    assert sum(len(keys[i]) for i in range(400, 800)) <= 15 * 400


def test_leaders_differ(spark):
    """Blocks of one group are not all led by one class."""
    rows = spark.range(1, 101).selectExpr("explode(sequence(0L, 15L)) key", "xxhash64(id) h", "id shape")
    got = L._with_lowest(rows, ["key"]).select("key", "low", "low_shape", "n").distinct().collect()
    assert len(got) == 16 and {r["n"] for r in got} == {100}
    assert len({r["low"] for r in got}) == L.LEADERS


def test_parity_counts_added_words(spark):
    """A word that is only added flips one bit: five words longer, four others replaced."""
    pairs = spark.createDataFrame([(45 << L._SIGNS, (50 << L._SIGNS) | ((1 << bits) - 1))
                                   for bits in (15, 16, 20)], "a long, b long")
    assert [r[0] for r in pairs.select(L._maybe_similar("a", "b")).collect()] == [True, False, False]


def test_normalised_lines(spark):
    """A lone blank before a letter is left as it is; all else is as by words."""
    lines = ["a b", " a  b ", "A, b\tc", "é à ñ", "x _ y", "1 2a  3", "  z", "a - b -c - ", ", a", "ß É"]
    rows = spark.createDataFrame([(t,) for t in lines], "t string").select(L._norm(F.col("t"))).collect()
    assert [r[0] for r in rows] == [" ".join(norm(t)) for t in lines]
