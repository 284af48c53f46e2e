import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import pieces, token_counts, token_files

from .cases import ODD, empty, odd, odd_rows, plain, table

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
MORE = ["foo  bar   baz \n\n x", "a\n b", " lead", "trail ", "t  ", "x  y", " 　z q", "it's 'tis don't", "a<|endoftext|> b <|endoftext|>", "\x1c \x1d a", "é́ ñ", "  two"]


def test_counts(spark, sf):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for df, rows in ((spark.read.parquet(f"{sf}/documents.parquet"), table(sf, "documents")), (odd(spark), odd_rows())):
        want = sorted(((r[0], len((r[1] or "").encode()), n := len(sp.encode(r[1] or "")), n > 4096) for r in rows), key=repr)
        assert plain(token_counts.token_counts(df, PIECES).select("doc_id", "n_bytes", "n_tokens", "over_limit")) == want
    assert token_counts.token_counts(empty(spark), PIECES).count() == 0


def test_every_prefix(sf):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    c = token_counts.PrefixCounter(PIECES)
    for text in [x[:100] for x in ODD if x] + MORE + [r[1][-80:] for r in table(sf, "documents")[:60]]:
        want = [len(sp.encode(text[:i])) for i in range(len(text) + 1)]
        assert c.at_prefixes(text) == want
        for budget in (0, 1, 3, 7, 20, 1000):
            assert c.longest_prefix(text, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_prefix_rows(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = token_counts.prefix_counts(odd(spark), PIECES).where("doc_id = 17").first().counts
    assert got == [len(sp.encode(" ".join(ODD[17].split(" ")[:k]))) for k in range(1, len(got) + 1)]


def test_budgets_from_the_stored_table(spark, sf, tmp_path):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    stored = token_counts.stored_prefix_counts(spark.read.parquet(f"{sf}/documents.parquet"), PIECES, f"file://{tmp_path}/counts")
    texts = {r[0]: r[1] or "" for r in table(sf, "documents")}
    for budget in (1, 50, 4096):
        for r in token_counts.within_budget(stored, budget).where("doc_id % 7 = 0").collect():
            cuts = [len(sp.encode(texts[r.doc_id]))] if r.n_tokens <= budget else []
            words = texts[r.doc_id].split(" ")
            assert r.fit_words == len(r.counts) or r.counts[r.fit_words] > budget
            assert r.fit_tokens == (len(sp.encode(" ".join(words[: r.fit_words]))) if r.fit_words and "  " not in texts[r.doc_id] else r.fit_tokens) <= budget
            assert not cuts or r.fit_tokens == cuts[0]


def test_encoder(sf):
    """Alone, all together, and in slices, each text gets the library's ids."""
    t, e = Tokenizer.from_file(BPE), token_files.WordEncoder(BPE)
    texts = [x or "" for x in ODD] + MORE + [r[1] for r in table(sf, "documents")]
    want = [[*t.encode(x, add_special_tokens=False).ids, 0] for x in texts]
    assert [e.encode(pa.array([x]), 0)[0].tolist() for x in texts] == want
    old = pieces.SLICE_BYTES
    for size in (old, 1000):
        pieces.SLICE_BYTES = size
        got = []
        for part in pieces.slices(pa.array([x or None for x in texts], pa.string())):
            ids, n = e.encode(part, 0)
            got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        assert got == want
    pieces.SLICE_BYTES = old


def brute(rows):
    t, at, out = Tokenizer.from_file(BPE), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


def test_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert plain(token_files.round_trip(docs, BPE)) == brute([r[:2] for r in table(sf, "documents")])
    assert plain(token_files.round_trip(odd(spark), BPE)) == brute([r[:2] for r in odd_rows()])
    assert token_files.round_trip(empty(spark), BPE).count() == 0


def test_random_access(spark, tmp_path):
    index = token_files.write_files(odd(spark), f"file://{tmp_path}/files", BPE).collect()
    t = Tokenizer.from_file(BPE)
    for r in index:
        if r.doc_id == 19:
            reader = token_files.SequenceReader(r.path)
            want = [*t.encode(ODD[19], add_special_tokens=False).ids, 0]
            assert np.concatenate(list(reader.ids(r["at"], r.n_tokens))).tolist() == want
            row = r["at"] // reader.sequence + 1
            ids, mask = reader.sequence_and_mask(row)
            k = row * reader.sequence - r["at"]
            assert len(ids) == len(mask) == reader.sequence and all(mask.to_pylist()) and ids.to_pylist() == want[k : k + len(ids)]


def test_all_prefixes_are_stored(spark, sf):
    """The table has the library's count at every character, filled by the recurrence and not by encoding whole words."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [*ODD[:30], *MORE, *[r[1][-60:] for r in table(sf, "documents")[:20]]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in token_counts.prefix_counts(df, PIECES).collect():
        text = texts[r.doc_id] or ""
        if len(text) < 2000:
            assert r.prefixes == [len(sp.encode(text[: k + 1])) for k in range(len(text))], text
        else:
            assert len(r.prefixes) == len(text) and r.prefixes[-1] == len(sp.encode(text))
