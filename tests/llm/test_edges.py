"""Very long texts and repeated rows of the operators that had no such test."""

import gc
import hashlib
import random
import weakref

import numpy as np

from missivelake.llm import decontaminate, grammar_ids, near_copies, packing, pii, tokens


def test_packing_of_a_text_of_many_windows_and_of_repeated_rows(docs_of):
    encoder = tokens.encoder(tokens.default_path("word_bpe_49k.json"))
    rng = random.Random(8)
    long = " ".join(rng.choice(["alpha", "beta,", "gamma.\n", "x9"]) for _ in range(40_000))
    rows = [(1, long), (2, "twice the same"), (2, "twice the same"), (3, long)]
    pieces = packing.pack(docs_of(rows)).collect()
    whole = {i: np.frombuffer(encoder.encode([t])[0] + b"\x01\0\0\0", "<u4").tolist() for i, t in rows}
    assert len(whole[1]) > 10 * packing.CAPACITY
    for i in (1, 3):
        own = sorted((p["start"], np.frombuffer(bytes(p["ids"]), "<u4").tolist()) for p in pieces if p["doc_id"] == i)
        assert [x for _, ids in own for x in ids] == whole[i]
    assert [p["length"] for p in pieces if p["doc_id"] == 2] == [len(whole[2])] * 2
    fill = {}
    for p in pieces:
        fill.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in fill.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist() and sum(n for _, n in parts) <= packing.CAPACITY


def test_a_document_larger_than_a_shard(docs_of):
    encoder = tokens.encoder(tokens.default_path("byte_bpe_50k.json"))
    rng = random.Random(5)
    long = " ".join(rng.choice(["one", "two,", "three", "1234"]) for _ in range(20_000))
    rows = [(5, "before"), (6, long), (7, "after"), (7, "after"), (8, None)]
    table = grammar_ids.shards(docs_of(rows).coalesce(1), shard_ids=500)
    got = sorted(grammar_ids.read_documents(table).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [5, 6, 7, 7, 8]
    at = 0
    for r, (_, t) in zip(got, rows):
        ids = np.frombuffer(encoder.encode([t or ""])[0] + b"\0\0\0\0", "<u4").tolist()
        assert (r["start"], r["n_tokens"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) == (at, len(ids), ids)
        at += len(ids)


def test_personal_data_in_a_very_long_text_and_in_repeated_rows(docs_of):
    filler = "plain words without any data " * 40_000
    text = f"{filler}ann.lee@example.com {filler} 10.0.0.1 end"
    rows = [(1, text), (2, "mail b@c.de"), (2, "mail b@c.de"), (3, None)]
    found = pii.find(docs_of(rows)).collect()
    base = lambda r: sorted((s["kind"], s["start"], s["end"]) for s in r["spans"] if s["is_base"])
    mail = len(filler)
    ip = text.index("10.0.0.1")
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(base(r))
    assert by_id == {1: [[("email", mail, mail + 19), ("ip", ip, ip + 8)]], 2: [[("email", 5, 11)]] * 2, 3: [[]]}


def test_near_copies_of_very_long_texts(docs_of):
    rng = random.Random(12)
    words = [f"w{rng.randrange(10**7)}" for _ in range(60_000)]
    edited = [*words]
    for k in range(0, 60_000, 100):
        edited[k] = "other"
    far = [f"v{rng.randrange(10**7)}" for _ in range(60_000)]
    rows = [(7, " ".join(words)), (3, " ".join(edited)), (9, " ".join(far)), (9, " ".join(far)), (10, "a short one of six words")]
    got = {r["doc_id"]: r["component_id"] for r in near_copies.similar_dedup(docs_of(rows)).collect()}
    assert got == {7: 3, 3: 3, 9: 9, 10: 10}
    assert len({hashlib.sha256(t.encode()).hexdigest() for _, t in rows}) == 4


def test_a_worker_keeps_the_tables_of_one_operator():
    made = weakref.ref(tokens.encoder(tokens.default_path("word_bpe_49k.json")))
    gc.collect()
    assert made() is not None and made() is tokens.encoder(tokens.default_path("word_bpe_49k.json"))
    near_copies.shingle_set("one two three four five six")
    gc.collect()
    assert made() is None  # it went when another operator's tables came
    assert decontaminate.gram_hashes(["a", "b", "c", "d"]).tolist() == decontaminate.gram_hashes(["a", "b", "c", "d"]).tolist()


def test_encoding_new_pieces_does_not_look_for_cycles():
    encoder = tokens.PieceEncoder(tokens.default_path("byte_bpe_50k.json"))
    text = " ".join("abcdefghij"[k % 10] * (1 + k % 7) + chr(97 + k % 26) * (1 + k // 700) + chr(97 + k // 26 % 26) + ",;!"[k % 3] for k in range(9000))
    looked = []
    note = lambda phase, info: looked.append(phase)
    gc.callbacks.append(note)
    try:
        found = encoder.encode([text])
    finally:
        gc.callbacks.remove(note)
    assert gc.isenabled() and not looked
    assert np.frombuffer(found[0], "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
