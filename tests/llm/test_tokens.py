from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from pyarrow import fs, ipc
from tokenizers import Tokenizer

from tierkeep.llm import token_counts, token_files
from tierkeep.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " \n\t", "Hello, World. hello. HELLO!! it's a 'test'.", "<|endoftext|> <|EndOfText|>a.<|startoftext|>", "Σίσυφος İstanbul é Ǆ", "a\x0bb\x1cc d e. ,. ., x,", "123abc 4.5,6", "中文 字。 ﬁ", "\x00\x01 a\x85b"]


def whole(texts):
    tokenizer = Tokenizer.from_file(WORDS)
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_word_by_word_equals_whole_texts(read):
    texts = ODD + [r.text or "" for r in read("documents").collect()]
    rng = random.Random(5)
    texts += ["".join(rng.choice("aB.,'s é\n\t1!<|>́ ") for _ in range(60)) for _ in range(300)]
    encoder = token_files.WordEncoder(WORDS)
    for _ in range(2):  # also from memory
        got = [np.frombuffer(ids, encoder.kind).tolist() for ids in encoder.encode([t.encode() for t in texts])]
        assert got == whole(texts)


def check_round_trip(spark, docs, **options):
    folder = scratch_path(spark, "tokens")
    index = token_files.write_tokens(docs, folder, WORDS, **options)
    rows = token_files.read_documents(index, folder).collect()
    known = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.select("doc_id", "text").collect()))
    start = 0
    got = sorted(rows, key=lambda r: r.start)
    for (known_id, doc_id, _), ids, row in zip(known, whole([t for *_, t in known]), got, strict=True):
        stream = np.array([*ids, 1], "<u4")
        assert (row.doc_id is not None, row.doc_id or 0) == (known_id, doc_id)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(stream), zlib.crc32(stream.tobytes()))
        start += len(stream)
    return folder, index, start


def test_round_trip(spark, read):
    check_round_trip(spark, read("documents"))


def test_many_files_and_random_access(spark, read):
    folder, index, total = check_round_trip(spark, read("documents"), sequence=64, file_ids=5000)
    system, path = token_files._filesystem(folder)
    files = [f.base_name for f in system.get_file_info(fs.FileSelector(path))]
    assert len(files) == index.select("file").distinct().count() > 4
    held = 0
    for name in files:
        opened = token_files.TokenFile(folder, name)
        with ipc.open_file(system.open_input_file(f"{path}/{name}")) as plain:
            sequences = sum(plain.get_batch(i).num_rows for i in range(plain.num_record_batches))
            table = plain.read_all()
        for k in (0, sequences - 1):
            ids, mask = opened.sequence(k)
            assert ids.tolist() == table["ids"][k].as_py() and mask.tolist() == table["mask"][k].as_py()
        held += int(np.concatenate([opened.sequence(k)[1] for k in range(sequences)]).sum())
        opened.close()
    assert held == total


def test_round_trip_edges(spark, edge, nothing):
    check_round_trip(spark, edge)
    check_round_trip(spark, nothing)


def test_section_counts_equal_brute_force(spark, read, edge, nothing):
    spans = token_counts.Spans(BYTES, public_tokenizers.PATTERN)
    rng = random.Random(6)
    for text in ODD + ["".join(rng.choice("ab é\n\n 中 .") for _ in range(50)) for _ in range(100)]:
        first, last = spans.of(text)
        starts = token_counts.line_starts(text)
        held, crossing = token_counts.attributed(first, last, starts, len(text))
        expected, across = [0] * len(starts), [0] * len(starts)
        owner = [sum(s <= i for s in starts) - 1 for i in range(len(text))]
        for a, b in zip(first.tolist(), last.tolist()):
            own = owner[a:b]
            home = min(set(own), key=lambda s: (-own.count(s), s))
            expected[home] += 1
            across[home] += len(set(own)) > 1
        assert held.tolist() == expected and crossing.tolist() == across
        assert "".join(text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])) == text
    out = token_counts.section_tokens(edge, BYTES, public_tokenizers.PATTERN)
    assert out.select("doc_id").distinct().count() == edge.select("doc_id").distinct().count()
    assert out.where("field = 'source'").count() == edge.count()
    assert token_counts.section_tokens(nothing, BYTES, public_tokenizers.PATTERN).count() == 0
    table = token_counts.section_tokens(read("documents"), BYTES, public_tokenizers.PATTERN)
    sums = table.groupBy("doc_id").agg({"n_tokens": "sum", "doc_tokens": "max", "n_chars": "sum"}).collect()
    lengths = {r.doc_id: len(f"{r.source or ''} {r.lang or ''} {r.text or ''}") for r in read("documents").collect()}
    assert all(r["sum(n_tokens)"] == r["max(doc_tokens)"] and r["sum(n_chars)"] == lengths[r.doc_id] for r in sums)
