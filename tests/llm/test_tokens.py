import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from tagwerk.llm import token_count, token_file
from tagwerk.llm.queries import tokenizer_path
from tagwerk.session import local_dir, qualified, scratch_path

from .helpers import documents, words

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
HARD = ["a  b", " a", "a ", "a\n\n b", "x<|endoftext|> y", "<|startoftext|>A<|ENDOFTEXT|>", "ΣΑΣ Σ ς", "İstanbul  DON'T won't 'S",
        "a\x1cb \x1c\x1c", "　x y 1234 ½²", "é É ́ é", "日本語 テスト 🙂🙂", "\t", "a\r\nb", "don't 's", "x y",
        "ﬁ ǅ ẞ", "a\x00b c", "word," * 50, "\n", " ", "  ", "A" * 3000, "ÀÉÎ õ ÿ", "a​b", "'", "''s 'll"]


def _texts():
    rng = random.Random(2)
    return [*HARD, *[words(rng, n) for n in (1, 5, 50, 2000)],
            *["".join(rng.choice("ab'sT, \n\t1é́Σ日<|>") for _ in range(40)) for _ in range(300)]]


@pytest.mark.parametrize("remember", [3, 400_000])
def test_counts_equal_the_library(remember):
    own, library = token_count.MergeCounter(WORD, remember), Tokenizer.from_file(WORD)
    for t in _texts():
        assert own.count(t) == len(library.encode(t, add_special_tokens=False).ids), t


@pytest.mark.parametrize("remember", [3, 400_000])
def test_ids_equal_the_library(remember):
    own, library = token_file.Encoder(BYTE, remember), Tokenizer.from_file(BYTE)
    for t in _texts():
        assert np.frombuffer(own.encode(t), own.kind).tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_letters_of_newer_unicode_versions_count_as_in_the_library():
    own, library = token_count.MergeCounter(WORD), Tokenizer.from_file(WORD)
    newer = [0xA7CB, 0xA7DC, 0x18D9C, 0x18E46, 0x32808, 0x32988, 0x3D85C, 0x1DF48, 0x10D50, 0x16EA0, 0x1C89]
    texts = [f"{before}{chr(c)}{after}" for c in newer for before, after in (("", ""), ("a", "b"), ("that", "it"), ("Ä1", "́"))]
    assert [own.count(t) for t in texts] == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def test_merging_takes_the_lowest_rank_first():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2, ("x", "x"): 3}
    assert token_count.merges(list("abc"), ranks) == 2  # bc, then a+bc
    assert token_count.merges(list("xxx"), ranks) == 1  # leftmost first, then no pair is left
    assert token_count.merges(list("xxxx"), ranks) == 2
    assert token_count.merges(["a"], ranks) == token_count.merges([], ranks) == 0


def test_count_query_rows(spark):
    rows = [(i, t) for i, t in enumerate([None, "", *HARD])] + [(None, "no id"), (1, "again"), (1, "again"), (5, "tok " * 3000)]
    got = token_count.count_tokens(documents(spark, rows), WORD).collect()
    library = Tokenizer.from_file(WORD)
    want = [(d, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for d, t in rows]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert token_count.count_tokens(documents(spark, []), WORD).collect() == []


def _expected(rows):
    library, start, out = Tokenizer.from_file(BYTE), 0, []
    def place(row):  # Spark's hash of the text, signed; that of null is its seed
        h = 42 if row[1] is None else xxhash.xxh64_intdigest(row[1].encode(), 42)
        return row[0] is not None, row[0] or 0, h - (1 << 64) * (h >> 63), row[1] or ""

    for d, t in sorted(rows, key=place):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("length", [7, 2048])
def test_files_read_back_every_document(spark, length):
    rows = [(i * 3 % 101, t) for i, t in enumerate([None, "", *_texts()][:90])] + [(None, "no id"), (4, "twice"), (4, "twice")]
    got = token_file.token_files(spark, documents(spark, rows).repartition(5), BYTE, length=length)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got.collect()), key=lambda r: r[1])
    assert got == _expected(rows)
    assert token_file.token_files(spark, documents(spark, []), BYTE).collect() == []


def test_sequences_are_equal_length_and_masked(spark, scratch):
    rows = [(i, words(random.Random(i), 40)) for i in range(50)]
    shards = token_file.write_token_files(documents(spark, rows), BYTE, scratch, length=16, per_batch=4).orderBy("shard").collect()
    library, stream = Tokenizer.from_file(BYTE), []
    for _, t in rows:
        stream += [*library.encode(t, add_special_tokens=False).ids, 0]
    read = []
    for s in shards:
        shard = token_file.Shard(s.ids_path)
        assert pa.types.is_fixed_size_list(shard.reader.schema.field("input_ids").type)
        n = -(-s.n_tokens // 16)
        assert sum(shard.reader.get_batch(k).num_rows for k in range(shard.reader.num_record_batches)) == n
        part = []
        for k in range(n):
            ids, mask = shard.sequence(k)
            assert not ids.flags.writeable and mask.buffers()[1].address == shard.reader.get_batch(k // 4).column(1).flatten().buffers()[1].address
            mask = mask.to_numpy(zero_copy_only=False)
            assert len(ids) == len(mask) == 16 and (mask.all() or k == n - 1)
            part += ids[mask].tolist()
        assert len(part) == s.n_tokens
        read += part
        some = np.concatenate(list(shard.ids(5, 100)))  # across batches
        assert some.tolist() == part[5:105]
    assert read == stream


def test_many_rows_without_an_id_are_many_shards(spark):
    rows = [(None, f"text {i}") for i in range(600)] + [(i, "x") for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small shards stay apart
    try:
        shards = token_file.write_token_files(documents(spark, rows).repartition(4), BYTE, scratch_path(spark, "hot-id"))
        sizes = [r.n_docs for r in shards.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 900 and max(sizes) < 500


def test_a_folder_without_a_scheme_is_where_spark_puts_it(spark):
    folder = local_dir(scratch_path(spark, "plain-path"))
    assert qualified(spark, folder) in (f"file://{folder}", f"file:{folder}") and qualified(spark, "hdfs://host/a") == "hdfs://host/a"
    docs = documents(spark, [(1, "a b"), (2, None)])
    got = token_file.token_files(spark, docs, BYTE, folder=folder).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == [3, 1]
