"""The operators of the llm package against brute force on a small table with nulls, empty texts, copies and ties."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallymart.llm import (
    char_language,
    compression_rules,
    count_vector_join,
    exact_dedup,
    fm_substring,
    lattice_scoring,
    path_templates,
    pieces,
    rows,
    secret_ownership,
    unigram_codec,
    vector_packing,
)
from tallymart.llm.pieces import MARK_BYTES, read_vocabulary

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
KIND = "doc_id long, text string, lang string, source string, n_chars long, kept boolean"


def _texts() -> list:
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    long = [" ".join(draw.choice(words, 60)) for _ in range(6)]
    near = long[0].split()
    near[30] = "other"
    passage = " ".join(f"p{i}" for i in range(20))
    return [
        *long, " ".join(near), long[1].replace(" ", "\n"), None, "", " \t\n", "one", "one", "One two",
        f"start {passage} end", f"{passage}", "x" * 5000, "é 日本 🙂 ▁", 'token = "aaaabbbbccccddddeeeeffff0"',
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 3}", len(t or ""), True) for i, t in enumerate(_texts())]
    rows.append((3, _texts()[3], "en", "s0", 1, False))  # a repeated row
    rows.append((None, "null id", None, None, None, None))
    return spark.createDataFrame(rows, KIND)


def test_exact_groups(docs):
    found = exact_dedup.duplicate_groups(docs).collect()
    assert len(found) == docs.count()
    groups = defaultdict(list)
    for row in docs.collect():
        groups[(row.text or "").translate(dict.fromkeys([32, 9, 10, 11, 12, 13], ""))].append(row)
    sizes = {hashlib.sha256(k.encode()).hexdigest(): len(v) for k, v in groups.items()}
    assert all(row.group_size == sizes[row.digest] for row in found)
    assert sum(row.kept for row in found) == len(groups)
    assert exact_dedup.drop_duplicates(docs).count() == len(groups)


def test_near_classes(docs):
    found = count_vector_join.near_duplicates(docs, size=3, percent=80).collect()
    assert len(found) == docs.count()
    by_id = {row.id: row for row in found}
    assert by_id[6].component_id == 0 and by_id[7].component_id == 1 and by_id[12].component_id == 11
    assert by_id[8].n_shingles == by_id[9].n_shingles == by_id[10].n_shingles == 0 and by_id[9].component_id == 9
    assert by_id[13].component_id == 13


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_overlap_is_the_smallest_that_links(percent):
    sizes = count_vector_join.Sizes(percent)
    for a in range(1, 30):
        for b in range(a, 40):
            least = next((o for o in range(a + b + 1) if 100 * o >= percent * (a + b - o)), None)
            assert sizes.overlap(a, b) == least


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_links_share_a_bucket(percent):
    draw = np.random.default_rng(5)
    sizes, linked = count_vector_join.Sizes(percent), 0
    for n in [*range(1, 60), *range(60, 600, 9)] * 3:
        grams = np.unique(draw.integers(1, 2**62, n).astype(np.uint64))
        changed = int(draw.integers(0, max(1, round(n * (100 - percent) / 60)) + 1))
        new = draw.integers(1, 2**62, int(draw.integers(0, changed + 1))).astype(np.uint64)
        other = np.unique(np.concatenate([grams[changed:], new]))
        if len(np.intersect1d(grams, other)) >= sizes.overlap(len(grams), len(other)) and len(other):
            linked += 1
            keys = (count_vector_join.cell_keys(one, sizes) for one in (grams, other))
            assert len(np.intersect1d(*keys))
    assert linked > 100


def test_repeated_passages(docs):
    found = {row.id: row for row in fm_substring.repeated_words(docs).collect()}
    assert found[15].n_removed == 20 and found[14].n_removed == 0 and found[7].n_removed == 60
    assert found[8].n_words == 0 and found[3].n_removed == 0 and found[None].n_removed == 0


def test_wavelet_rank():
    values = np.random.default_rng(0).integers(0, 11, 300)
    matrix = fm_substring.WaveletMatrix(values, 4)
    symbols, low = np.arange(11), np.arange(11) * 7
    under, upto = matrix.rank(symbols, low, low + 100)
    for s, a, u, v in zip(symbols, low, under, upto):
        assert u == (values[:a] == s).sum() and v == (values[: a + 100] == s).sum()


def test_pieces_and_packing(docs):
    rows = vector_packing.pack(vector_packing.pieces(docs, TOKENIZER, tokens=64), vector_packing.Capacity(64, 4, 5000))
    held = defaultdict(list)
    for row in rows.collect():
        held[row.sequence_id].append((row.offset, row.length))
    for parts in held.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 64 and len(parts) <= 4


def test_attention_capacity_is_held():
    lengths = np.array([40, 30, 30, 20, 10, 10, 5])
    for rule in ("norm", "dot"):
        bins, _ = vector_packing.best_fit(lengths, vector_packing.Capacity(64, 3, 2000, (1, 1, 1), rule))
        for one in set(bins):
            own = lengths[bins == one]
            assert own.sum() <= 64 and len(own) <= 3 and (own**2).sum() <= 2000


def test_codec_round_trip(docs):
    coded = docs.select("text", unigram_codec.encode("text", PIECES).alias("ids"))
    rows = coded.withColumn("back", unigram_codec.decode("ids", PIECES)).collect()
    assert all(row.back == (row.text or "").replace("▁", " ") for row in rows)
    lists = docs.sparkSession.createDataFrame([(1, None), (2, []), (3, rows[0].ids)], "i int, ids array<int>").coalesce(1)
    assert [r.t for r in lists.select(unigram_codec.decode("ids", PIECES).alias("t")).collect()] == ["", "", rows[0].back]


def _all_segmentations(data: bytes, scores: dict) -> float:
    if not data:
        return 1.0
    return sum(
        math.exp(scores[data[:k]]) * _all_segmentations(data[k:], scores)
        for k in range(1, len(data) + 1)
        if data[:k] in scores
    )


def test_lattice_is_the_sum_over_segmentations(docs):
    vocab = read_vocabulary(PIECES)
    scores = {t: float(vocab.score[i]) for i, t in enumerate(vocab.text) if t and i not in vocab.byte_ids}
    for word in (b"the", b"thinking", b"onhaed"):
        assert lattice_scoring.lattice(PIECES)(word) == pytest.approx(
            math.log(_all_segmentations(MARK_BYTES + word, scores))
        )
    rows = lattice_scoring.lattice_scores(docs, F.col("doc_id") < 5, PIECES).collect()
    assert len(rows) == docs.count()
    empty = next(row for row in rows if row.id == 9)
    assert empty.n_tokens == empty.n_known == 1


def test_quality_counts():
    press = compression_rules.zstandard.ZstdCompressor()
    text = b"a b c d e\na b c d e\n\n#x\na b c d e f"
    n, chars, symbols, lines, repeats, failed, *_ = compression_rules.judged(text, compression_rules.Bands(), press)
    assert (n, chars, symbols, lines, repeats, failed) == (17, 18, 1, 1, 15, True)
    assert compression_rules.judged(b"", compression_rules.Bands(), press)[0] == 0


def test_secret_spans(docs):
    rows = {row.id: row.spans for row in secret_ownership.scan(docs).collect()}
    assert [(s.kind, s.start, s.stop) for s in rows[18]] == [("assign", 0, 34), ("hex", 9, 34)]
    assert rows[8] is None
    cleaned = {row.doc_id: row.text for row in secret_ownership.redacted(docs).collect()}
    assert cleaned[18] == '[SECRET]"' and cleaned[8] is None and cleaned[11] == "one"


def test_urls(spark):
    urls = [None, "no scheme", "http://A.Example.COM/de/x?y", "https://x.net", "http://b.org/fr/1#t", "http://b.org/fr2"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = {row.id: row for row in path_templates.judge(pages).collect()}
    assert (rows[2].host, rows[2].path, rows[2].rule) == ("a.example.com", "/de/x", "example.com/de/")
    assert rows[0].host == rows[1].path == "" and rows[0].rule is None
    assert rows[3].rule is None and rows[4].verdict == "allow" and rows[5].rule is None


def test_language(spark):
    texts = [("the cat and the dog in the house", "en"), ("le chat et le chien dans la maison", "fr")]
    rows = [(i, texts[i % 2][0] + " " * (i % 7), texts[i % 2][1]) for i in range(60)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = char_language.fit(train, "doc_id", "text", "lang")
    asked = spark.createDataFrame([("the house",), ("la maison",), (None,), ("123",)], "text string")
    found = [row.x for row in asked.select(char_language.language("text", model).alias("x")).collect()]
    assert [x.lang_pred for x in found] == ["en", "fr", "und", "und"] and all(0 <= x.score <= 1 for x in found)


def test_empty_table(docs):
    none = docs.limit(0)
    assert exact_dedup.duplicate_groups(none).count() == 0
    assert count_vector_join.near_duplicates(none).count() == 0
    assert fm_substring.repeated_words(none).count() == 0
    assert vector_packing.pack(vector_packing.pieces(none, TOKENIZER)).count() == 0
    assert lattice_scoring.lattice_scores(none, F.lit(True), PIECES).count() == 0
    assert secret_ownership.scan(none).count() == 0


def test_smallest_owners_against_every_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 4, 60)
    segments = [np.concatenate([base[a : a + n], rng.integers(0, 4, 5)]) for a, n in rng.integers(9, 30, (40, 2))]
    owners = rng.permutation(40)
    found = fm_substring.smallest_owners(segments, owners, 9)
    held = [{tuple(s[i : i + 9]) for i in range(len(s) - 8)} for s in segments]
    for segment, least in zip(segments, found):
        for place, value in enumerate(least):
            window = tuple(segment[place : place + 9])
            assert value == min(owner for owner, own in zip(owners, held) if window in own)


def exhaustive(data, known, byte_cost):
    """The highest score over all ways to cut ``data`` into pieces, or into a character's bytes where none spells it."""
    best = {len(data): 0.0}
    for start in reversed(range(len(data))):
        if data[start] & 0xC0 == 0x80:
            continue
        width = next(w for w in (1, 2, 3, 4) if start + w == len(data) or data[start + w] & 0xC0 != 0x80)
        ways = [cost + best[start + len(p)] for p, cost in known.items() if data.startswith(p, start)]
        if data[start : start + width] not in known:
            ways.append(byte_cost * width + best[start + width])
        best[start] = max(ways)
    return best[0]


@pytest.mark.parametrize("inner", [False, True])
def test_unigram_ids_are_the_best_of_all_segmentations(inner):
    """Against all segmentations, in blocks and alone, with a vocabulary of its own; ``inner``: a piece with a mark inside."""
    rng = random.Random(6)
    plain = {"".join(rng.choice("abcé漢▁"[: 6 - (n > 0)]) for n in range(rng.randrange(1, 5))) for _ in range(60)} - {"c", "漢"}
    plain = sorted({"▁" + p.strip("▁") if p.startswith("▁") else p for p in plain} | {"▁"} | ({"a▁b"} if inner else set()))
    scores = [(p, -rng.random() * 9 - 0.5) for p in plain]
    bytes_ = list(range(len(scores), len(scores) + 256))
    vocab = pieces.vocabulary(scores + [(f"<0x{b:02X}>", -12.0) for b in range(256)], bytes_)
    coded = unigram_codec.Codec(vocab, most=50)
    assert vocab.splits is not inner
    texts = ["".join(rng.choice("aabbcé漢😀 ") for _ in range(rng.randrange(0, 14))) for _ in range(400)] + ["", " ", "  a ", "a▁b", "ab " * 900, "b" * 2000]
    known = {p.encode(): s for p, s in scores}
    for text, ids in zip(texts, coded.encode_all(texts), strict=True):
        ids = np.frombuffer(ids, "<i4").tolist()
        assert ids == np.frombuffer(coded.encode(text), "<i4").tolist()
        marked = ("▁" + text.replace(" ", "▁")).encode() if text else b""
        assert b"".join(vocab.text[i] for i in ids) == marked
        assert sum(float(vocab.score[i]) for i in ids) == pytest.approx(exhaustive(marked, known, -12.0))
        assert coded.decode(ids) == text.replace("▁", " ")


def _files(spark, tmp_path, docs, **more):
    path = str(tmp_path / "docs")
    docs.withColumns(more).write.parquet(path)
    return spark.read.parquet(path)


def _derived(name, scan):
    if name == "scan":
        return scan.filter("n_chars >= 0 OR n_chars IS NULL").select("*")
    if name == "explode":
        return scan.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    if name == "join":
        return scan.join(scan.sparkSession.range(2).withColumnRenamed("id", "copy"), F.col("copy") < 2)
    return scan.unionByName(scan)


@pytest.mark.parametrize("name", ["scan", "explode", "join", "union"])
def test_row_keys_of_derived_frames(spark, docs, tmp_path, name):
    frame = _derived(name, _files(spark, tmp_path, docs))
    keyed = rows.with_row_key(frame)
    assert keyed.count() == frame.count() == keyed.select(*rows.ROW_KEY).distinct().count()
    assert rows.with_row_key(keyed) is keyed
    texts = {(r.text or "").translate(dict.fromkeys([32, 9, 10, 11, 12, 13], "")) for r in docs.collect()}
    left = exact_dedup.drop_duplicates(frame)
    assert left.columns == frame.columns and left.count() == len(texts)
    assert count_vector_join.drop_near_duplicates(frame).filter("doc_id = 0").count() == 1


def test_clashing_names(spark, docs, tmp_path):
    clash = dict.fromkeys(["_metadata", "_spans", "_group", "_row_file", "_row_index"], F.lit("x"))
    frame = _files(spark, tmp_path, docs, **clash)
    want = exact_dedup.drop_duplicates(docs).count()
    plain = {r.doc_id: r.text for r in secret_ownership.redacted(docs).collect()}
    for done in (exact_dedup.drop_duplicates, count_vector_join.drop_near_duplicates, secret_ownership.redacted):
        out = done(frame)
        assert out.columns == frame.columns and out.filter("_row_file = 'x' AND _metadata = 'x' AND _spans = 'x'").count() == out.count()
    assert exact_dedup.drop_duplicates(frame).count() == want
    assert {r.doc_id: r.text for r in secret_ownership.redacted(frame).collect()} == plain
    parts = frame.select("*", F.lit(100).alias("length"))
    packed = vector_packing.pack(parts)
    assert packed.count() == frame.count() and packed.filter("_group = 'x'").count() == frame.count()


def test_recode_is_encode_then_decode(docs):
    ids = unigram_codec.encode("text", PIECES)
    rows = docs.select(unigram_codec.recode("text", PIECES).alias("r"), ids.alias("ids")).select(
        "r.*", F.col("ids").alias("apart"), unigram_codec.decode("ids", PIECES).alias("back")
    )
    assert all(r.ids == r.apart and r.text == r.back for r in rows.collect())


def test_new_words_are_encoded_many_at_a_time():
    import public_tokenizers

    from tallymart.llm.vector_packing import Encoder

    coder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    singly, real = [], coder._ids
    coder._ids = lambda texts: singly.extend(texts) or real(texts)
    texts = [" ".join(f"w{i}x{j} caf\u00e9{j}" for j in range(200)) for i in range(20)]
    odd = ["a  b", " x ", "\n y\tz", "a<|endoftext|> b", "", "   ", "\u0120 a\u0120b c", "a\u00a0b \u3000c d"]
    found = coder.encode(texts) + coder.encode(odd)
    assert found == real(texts + odd)
    assert len(singly) < 100
