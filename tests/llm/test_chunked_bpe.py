import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wardbook.llm import chunked_bpe
from wardbook.llm.chunked_bpe import Coder, assemble, chunk_bounds, decode, encode, vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def coder():
    return Coder(vocabulary(PATH))


def plain(text):
    tokenizer = Tokenizer.from_file(PATH)
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def random_text(rng, size):
    pieces = ["the ", "it's ", " ", "  \n", "Straße ", "\U0001f600", "12 345", "don't  ", "<|endoftext|>", "\t", "…", "naïve ", "a", "zz "]
    return "".join(rng.choice(pieces) for _ in range(size))


def test_any_cut_is_repaired(coder):
    """Whatever the chunks, cores and gaps together give the ids of the whole text."""
    rng = random.Random(3)
    reused = 0
    for _ in range(150):
        text = random_text(rng, rng.randint(1, 120))
        data, parts, low = text.encode(), [], 0
        while low < len(data):
            high = min(len(data), low + rng.randint(1, 90))
            while high < len(data) and data[high] & 0xC0 == 0x80:
                high += 1
            chunk = data[low:high]
            a, b, ids = coder.core(chunk, coder.encode([chunk.decode()])[0])
            if b > a and rng.random() < 0.7:
                parts.append({"at": low, "low": a, "high": b, "ids": ids.tobytes()})
                reused += len(ids)
            low = high
        got = assemble(coder, [text], [parts])[0]
        assert got.tolist() == coder.encode([text])[0].tolist()
        assert coder.decode(got) == text
    assert reused > 500


def test_chunks_follow_content():
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdefgh ijk é") for _ in range(20_000))
    one, two = ("x" * 300 + shared).encode(), ("other start " + shared).encode()

    def chunks(data):
        bounds = chunk_bounds(data)
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    assert b"".join(chunks(one)) == one
    common = set(chunks(one)) & set(chunks(two))
    assert sum(map(len, common)) > 0.8 * len(shared.encode())
    for chunk in chunks(one):
        chunk.decode()
    assert chunk_bounds(b"") == [0]


def test_queries_equal_the_library(spark, odd):
    passage = random_text(random.Random(5), 2_000)
    more = spark.createDataFrame([(100 + i, f"start {i} {passage} end {i}") for i in range(20)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    got = encode(docs, PATH, with_ids=True).collect()
    want = Counter((r.doc_id, *plain(r.text)) for r in docs.collect())
    assert Counter((r.id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    back = decode(encode(more, PATH, with_ids=True), PATH)
    assert dict(back.collect()) == dict(more.collect())
    assert encode(odd, PATH).count() == odd.count() and encode(odd.limit(0), PATH).count() == 0


def test_texts_are_shuffled_once(spark, sf_dir, capsys):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        encoded = encode(docs, PATH)
        encoded.write.format("noop").mode("overwrite").save()
        encoded.collect()
        plan = encoded._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("_pack_rows") == 1 and "ReusedExchange" in final


def test_both_encoders_agree(coder):
    rng = random.Random(11)
    texts = [random_text(rng, rng.randint(0, 60)) for _ in range(400)]
    texts += ["".join(chr(c) for c in rng.sample(range(1, 0xD800), 50)) for _ in range(200)]
    library = Tokenizer.from_file(PATH)
    assert coder.fast is not None
    assert [e.tolist() for e in coder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_forms_are_left_to_the_library():
    file = json.loads(vocabulary(PATH))
    file["normalizer"] = {"type": "Lowercase"}
    other = Coder(json.dumps(file))
    library = Tokenizer.from_str(json.dumps(file))
    text = "Some TEXT, in Upper case"
    assert other.fast is None
    assert other.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_chunk_in_most_documents(spark, monkeypatch):
    monkeypatch.setattr(chunked_bpe, "PLACE_PARTS", 4)
    passage = random_text(random.Random(6), 3_000)
    docs = spark.createDataFrame([(i, passage if i % 3 else f"own {i} " + passage[: 40 * i]) for i in range(60)], "doc_id long, text string")
    got = Counter((r.id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode(docs, PATH).collect())
    assert got == Counter((r.doc_id, *plain(r.text)) for r in docs.collect())


def test_driver_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.id: r for r in encode(docs, PATH).collect()}
    for r in docs.collect():
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == plain(r.text)
