"""The registered queries of the llm package, and the pipeline, against plain Python over the smallest tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from tallymart.llm import compression_rules, queries
from tests.oracle import connect

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def shingles(text, size):
    held = words((text or "").translate(ASCII_LOWER))
    size = min(size, len(held))
    return {tuple(held[i : i + size]) for i in range(len(held) - size + 1)} if held else set()


def classes(sets, percent):
    """Smallest id that each id reaches, by comparing every pair."""
    ids = sorted(sets)
    parent = {one: one for one in ids}

    def root(one):
        while parent[one] != one:
            one = parent[one]
        return one

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {one: root(one) for one in ids}


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()


def rows_of(spark, name, key="doc_id"):
    rows = queries.QUERIES[name](spark, FOLDER).collect()
    return {row[key]: row for row in rows}


def test_lattice_likelihood(spark, documents):
    found = rows_of(spark, "op1_lattice_likelihood")
    tokens = {d["doc_id"]: [*words((d["text"] or "").translate(ASCII_LOWER)), "\n"] for d in documents}
    held_out = {one: zlib.crc32(str(one).encode()) % 7 == 2 for one in tokens}
    counts = Counter(t for one, own in tokens.items() if not held_out[one] for t in own)
    total, kinds = sum(counts.values()), len(counts)
    assert len(found) == len(documents) and any(held_out.values())
    for one, own in tokens.items():
        row = found[one]
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in own)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held_out[one], len(own), total)
        assert row.n_known == sum(counts[t] > 0 for t in own)
        assert row.base_score == pytest.approx(base, rel=1e-9) and row.score < 0


def test_unigram_codec(spark, documents):
    found = rows_of(spark, "op2_unigram_codec")
    assert len(found) == len(documents)
    for d in documents:
        row = found[d["doc_id"]]
        assert row.round_trip and row.n_ids == len(row.ids) and row.n_bytes <= row.n_ids


def test_count_vector_join(spark, documents):
    found = rows_of(spark, "op3_count_vector_join")
    sets = {d["doc_id"]: shingles(d["text"], 3) for d in documents}
    expected = classes(sets, 90)
    assert {one: (row.n_shingles, row.component_id) for one, row in found.items()} == {
        one: (len(sets[one]), expected[one]) for one in sets
    }


def encoded(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = tokenizer.encode_batch(list(texts), add_special_tokens=False)
    return [[*one.ids, 2] for one in found]


def check_packing(rows, ids_of):
    """Every document's pieces hold its ids, and every sequence is filled without a gap."""
    held, pieces = defaultdict(list), defaultdict(list)
    for row in rows:
        held[row.sequence_id].append((row.offset, row.length))
        pieces[row.doc_id].append(row)
    assert pieces.keys() == ids_of.keys()
    for one, ids in ids_of.items():
        at, own = 0, sorted(pieces[one], key=lambda row: row.piece)
        assert len(own) == -(-len(ids) // 1024)
        for number, row in enumerate(own):
            part = b"".join(i.to_bytes(4, "little") for i in ids[row.start : row.start + row.length])
            assert (row.piece, row.start, row.ids_crc32) == (number, at, zlib.crc32(part))
            at += row.length
        assert at == len(ids)
    for parts in held.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 1024
    return len(held)


def test_vector_packing(spark, documents):
    rows = queries.QUERIES["op4_vector_packing"](spark, FOLDER).collect()
    ids_of = dict(zip((d["doc_id"] for d in documents), encoded(d["text"] or "" for d in documents)))
    used = check_packing(rows, ids_of)
    assert used <= 1.02 * sum(map(len, ids_of.values())) / 1024 + 1


SECRETS = {
    "assign": (r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}


def test_secret_ownership(spark, documents):
    found = rows_of(spark, "op5_secret_ownership")
    assert len(found) == len(documents)
    for d in documents:
        spans = []
        for rank, (kind, (pattern, group, least)) in enumerate(SECRETS.items()):
            for match in re.finditer(pattern, d["text"] or ""):
                if len(match.group(group)) >= least:
                    spans.append((match.start(), rank, f"{kind}:{match.start()}:{match.end()}"))
        named, row = [name for *_, name in sorted(spans)], found[d["doc_id"]]
        assert row.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        kinds = Counter(name.split(":")[0] for name in named)
        assert (row.n_assign, row.n_access, row.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert set(named) <= set(row.spans.split(","))


RULES = (("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("net", "/", "block"))


def test_path_templates(spark):
    pages = pq.read_table(f"{FOLDER}/pages.parquet").to_pylist()
    found = rows_of(spark, "op6_path_templates", "page_id")
    assert len(found) == len(pages)
    for page in pages:
        rest = (page["url"] or "").partition("://")[2]
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host) :]).group()
        host, row = host.translate(ASCII_LOWER), found[page["page_id"]]
        rule = next((r for r in RULES if f".{host}".endswith(f".{r[0]}") and path.startswith(r[1])), None)
        assert (row.host, row.path, row.rule) == (host, path, rule and rule[0] + rule[1])
        assert row.verdict in ("allow", "block") and (rule is None or row.verdict == rule[2])


def quality(text):
    own, text = words(text), text or ""
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    often = Counter(windows)
    inside = {i + k for i, window in enumerate(windows) if often[window] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if words(line)]
    failed = len(own) < 10 or 100 * len(inside) > 20 * len(own)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(inside), failed


def test_compression_bands(spark, documents):
    found = rows_of(spark, "op8_compression_bands")
    assert len(found) == len(documents)
    for d in documents:
        row = found[d["doc_id"]]
        expected = quality(d["text"])
        assert tuple(row)[1:7] == expected and not (row.kept and expected[-1])
    assert sum(row.kept for row in found.values()) >= 0.9 * sum(not row.base_failed for row in found.values())


def test_fm_substring(spark, documents):
    found = rows_of(spark, "op9_fm_substring")
    least = {}
    for d in sorted(documents, key=lambda d: d["doc_id"]):
        own = words(d["text"])
        for i in range(len(own) - 12):
            least.setdefault(tuple(own[i : i + 13]), d["doc_id"])
    for d in documents:
        own, row = words(d["text"]), found[d["doc_id"]]
        gone = {i + k for i in range(len(own) - 12) if least[tuple(own[i : i + 13])] < d["doc_id"] for k in range(13)}
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        assert (row.n_words, row.n_removed) == (len(own), len(gone))
        assert row.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_char_language(spark, documents):
    found = rows_of(spark, "op10_char_language")
    assert len(found) == len(documents)
    right = []
    for d in documents:
        row = found[d["doc_id"]]
        assert row.held_out == (zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0) and 0 <= row.score <= 1
        assert (row.lang_pred == "und") == (not any(c.isalpha() for c in d["text"] or ""))
        if row.held_out and d["lang"] and row.lang_pred != "und":
            right.append(row.lang_pred == d["lang"])
    assert sum(right) >= 0.9 * len(right)


def test_heavy_hitter_dedup_matches_its_sql(spark):
    query = queries.QUERIES["op7_heavy_hitter_dedup"](spark, FOLDER)
    twin = connect(FOLDER).execute(queries.ORACLES["op7_heavy_hitter_dedup"])
    names = [column[0] for column in twin.description]
    assert sorted(map(tuple, query.select(*names).collect())) == sorted(twin.fetchall())


def test_pipeline(spark, documents):
    """The documents left by plain versions of the first three stages are those packed; the ids of texts without a
    secret are the tokenizer's."""
    press = zstandard.ZstdCompressor(level=3)
    left = {}
    for d in documents:
        data = (d["text"] or "").encode()
        if not quality(d["text"])[-1] and compression_rules.judged(data, compression_rules.Bands(), press)[-1]:
            left[d["doc_id"]] = d["text"]
    groups = defaultdict(list)
    for one, text in left.items():
        groups["".join(words(text))].append((-len(text), one))
    left = {min(own)[1]: left[min(own)[1]] for own in groups.values()}
    named = classes({one: shingles(text, 5) for one, text in left.items()}, 80)
    left = {one: text for one, text in left.items() if named[one] == one}

    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {row.doc_id for row in rows} == left.keys()
    spans = rows_of(spark, "op5_secret_ownership")
    clean = {one: text for one, text in left.items() if not spans[one].spans}
    ids_of = dict(zip(clean, encoded(clean.values())))
    packed = defaultdict(list)
    for row in rows:
        packed[row.sequence_id].append((row.offset, row.length))
        if row.doc_id in ids_of:
            part = ids_of[row.doc_id][row.start : row.start + row.length]
            assert row.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
    for parts in packed.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
