"""BPE word table, Merkle manifest and prefix trie against plain Python, with the awkward rows."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallymart.llm import merkle_manifest, prefix_trie, word_table_bpe
from tallymart.llm.queries import TOKENIZER, bpe_word_table, manifest_rows, trie_rows

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- BPE -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encoded(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_library(spark, library):
    rng = random.Random(1)
    letters = [*"ab1 '.s \n\t\xa0  日é\x1c", "<|endoftext|>", "'re", "  ", "ࡰ"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(25))) for _ in range(600)]
    texts += [None, "", " ", "\n", "  x", "x " * 60_000, "y" * 30_000, "same words", "same words"]
    # every column name that the operator uses itself, and the hidden one of files
    names = "doc_id long, text string, words string, file string, row string, id string, ids string, codes string"
    docs = spark.createDataFrame([(i if i % 7 else None, t, *"abcdef") for i, t in enumerate(texts)], names)
    coded = word_table_bpe.encode(docs.repartition(3), TOKENIZER)
    assert coded.columns == ["id", "ids"]
    found = word_table_bpe.decode(coded, TOKENIZER).collect()
    wanted = sorted(((i if i % 7 else None, encoded(library, t)) for i, t in enumerate(texts)), key=str)
    assert sorted(((r.id, r.ids) for r in found), key=str) == wanted
    assert all(r.text == library.decode(r.ids, skip_special_tokens=False) for r in found)


def test_ids_that_are_no_text_decode_like_the_library(spark, library):
    lists = [[], [255, 50256, 0], [130, 130], [10, 222, 111], [50256]]
    rows = spark.createDataFrame(list(enumerate(lists)), "id long, ids array<int>")
    found = {r.id: r.text for r in word_table_bpe.decode(rows, TOKENIZER).collect()}
    assert found == {i: library.decode(ids, skip_special_tokens=False) for i, ids in enumerate(lists)}


def test_bpe_query_and_empty_table(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    wanted = []
    for r in docs:
        ids = encoded(library, r.text)
        wanted.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert rows_of(bpe_word_table(spark, SMALL)) == sorted(wanted, key=str)
    none = spark.createDataFrame([], "doc_id string, text string")
    assert word_table_bpe.decode(word_table_bpe.encode(none, TOKENIZER), TOKENIZER).collect() == []


# ---- manifest --------------------------------------------------------------------------------

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """The top and, for each node, the (place, run) on its way there."""
    ways, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        upper, joined = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for place, inside in enumerate(members[at : at + 8]):
                for i in inside:
                    ways[i].append((place, run))
            upper.append(sha("".join(run)))
            joined.append(sum(members[at : at + 8], []))
        nodes, members = upper, joined
    return nodes[0], ways


def manifest_by_hand(rows):
    def leaf(r, text):
        return sha("".join(map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))

    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    if not groups:
        return []
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
    trees = [tree([x[2] for x in groups[g]]) for g in order]
    root, upper = tree([top for top, _ in trees])
    out = []
    for g, (top, ways), up in zip(order, trees, upper):
        for (_, _, node, r), way in zip(groups[g], ways):
            steps, text = way + up, r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(r, text)
            for place, run in steps:
                folded = sha("".join([*run[:place], folded, *run[place + 1 :]]))
            proof = sha("".join(x for place, run in steps for i, x in enumerate(run) if i != place))
            out.append((r["doc_id"], node, top, root, proof, folded, folded == root))
    return sorted(out, key=str)


def scattered(count):
    rng = random.Random(3)
    ids = [None, 0, 1, -1, -40000, 2**62, -(2**63), 2**63 - 1, *range(70000, 70060)]
    return [
        (rng.choice(ids), rng.choice(["s", None]), rng.choice([None, "de", "é", "-", "=", ""]), rng.choice([None, 5]), rng.choice([None, "", "Abc É", "xx"]))
        for _ in range(count)
    ]


@pytest.mark.parametrize(
    "rows",
    [
        scattered(200),
        [(7, None, None, None, None)],
        [(9, "s", "de", 1, "T" * 100_000)] * 70,
        [(None, "s", "de", 1, f"T{i}") for i in range(100)],
        [],
    ],
    ids=["scattered", "one", "repeated", "null ids", "empty"],
)
def test_manifest(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    assert rows_of(manifest_rows(docs)) == manifest_by_hand([r.asDict() for r in docs.collect()])


def test_manifest_ignores_other_columns_and_refuses_texts_as_ids(spark):
    docs = spark.createDataFrame([(i, "s", "de", 1, "x") for i in range(9)], DOCS)
    plain = rows_of(manifest_rows(docs))
    clash = docs.selectExpr("*", *(f"'x' AS {c}" for c in ("_group", "r", "n", "leaf", "bucket", "steps", "root", "_metadata")))
    assert rows_of(manifest_rows(clash)) == plain
    with pytest.raises(ValueError):
        merkle_manifest.manifest(docs.selectExpr("'a' AS doc_id", "lang"), "doc_id", "lang", merkle_manifest.leaf_hash())


# ---- trie ------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def trie_by_hand(rows):
    own = {}
    for r in rows:
        if r["conv_id"] is not None:
            role, text = r["role"] or "", r["text"] or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(r["conv_id"], []).append((r["turn"] is not None, r["turn"] or 0, digest, (role, text)))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        taken = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        rebuilt[c] = tuple(own.get(base, [])[:taken] + turns[taken:])
    members, kids, sums = {}, {}, {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids.get(p, [])]
        own_bytes = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        sums[p] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + own_bytes)
    return sorted(
        (
            (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), *sums[p],
             sha(",".join(str(c) for c in sorted(m) if rebuilt[c] == p)))
            for p, m in members.items()
        ),
        key=str,
    )


def talks(count, depth):
    rng = random.Random(3)
    return [
        (c, t or None, rng.choice(["u", None, "a"]), rng.choice(["x", None, "é"]))
        for c in rng.sample(range(-50, count * 2), count)
        for t in range(rng.randrange(depth))
    ]


@pytest.mark.parametrize(
    ("rows", "group"),
    [
        ([*talks(150, 9), (None, 1, "u", "x")], 100_000),
        ([*talks(150, 9), *((1000, i, "u", "x") for i in range(100))], 3),
        ([(c, i, "u", "x" * 1000) for c in range(100) for i in range(12)], 2),
        ([(1, 1, "u", "x"), (1, 1, "u", "x"), (1, 1, "a", "x")], 100_000),
        ([], 100_000),
    ],
    ids=["mixed", "small groups, one long", "all alike", "repeated turns", "empty"],
)
def test_trie(spark, monkeypatch, rows, group):
    monkeypatch.setattr(prefix_trie, "GROUP", group)
    frame = spark.createDataFrame(rows, TURNS)
    wanted = trie_by_hand([r.asDict() for r in frame.collect()])
    assert rows_of(trie_rows(frame.selectExpr("*", "1 AS place", "2 AS keys", "3 AS digest", "4 AS size"))) == wanted
