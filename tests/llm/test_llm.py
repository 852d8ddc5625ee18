"""The ten operators against brute force, on texts with every odd case."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from tidewater.llm import bpe, chat, fingerprints, packing, quality, recompression, records, simhash, suffix, toxicity
from tidewater.llm.common import DEFAULT_SHARED

WORDS = "the of and river stone light under garden quiet idiot window paper seven blue walk morning".split()


def texts(seed=1, n=60):
    r = random.Random(seed)
    say = lambda k: " ".join(r.choice(WORDS) + r.choice(["", "", ".", ",", ".\n"]) for _ in range(k))
    shared = say(60)
    own = [say(r.randint(1, 120)) for _ in range(n - 10)]
    own = [t + " " + shared + " " + say(5) if i % 5 == 0 else t for i, t in enumerate(own)]
    odd = ["", None, " \n\t ", "a", "a" * 3000, "é ß 漢字 🙂 <|endoftext|> ǰ", "x  y \n z\r\n  ", own[0], own[0], own[1] + " more"]
    return own + odd


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, "en", 7) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, a int")


@pytest.fixture(scope="module")
def plain():
    return {i * 3: t or "" for i, t in enumerate(texts())}


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def rows(df, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_bpe(spark, docs, plain):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(bpe.round_trip(docs), "n_tokens", "ids_sha256", "decoded_sha256")
    for k, t in plain.items():
        ids = own.encode_ordinary(t)
        assert got[k] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t))
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decode(bpe.encode(docs)).collect()} == plain
    assert bpe.round_trip(empty(spark)).count() == 0


def test_records(spark, docs, plain):
    folder = f"{DEFAULT_SHARED}/test-records-{random.getrandbits(64)}"
    manifest = records.write(docs, folder).cache()
    got = rows(records.read(manifest, folder), "start", "n_tokens", "ids_crc32")
    library, at = Tokenizer.from_file(P.path("word_bpe_49k.json")), 0
    for k, t in plain.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        assert got[k] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    name = manifest.first()["name"]
    files, _ = records.filesystem(folder)
    whole = [k for k, _ in records.fetch(files, name)]
    picks = np.array([2, 0, 1])
    assert [k for k, _ in records.fetch(files, name, picks)] == [whole[i] for i in picks]
    framed = bytearray(records.frame(b"abc"))
    framed[13] ^= 1
    with pytest.raises(records.BadRecord):
        records.unframe(memoryview(framed), 0)


def test_packing(spark, docs, plain):
    got = packing.pack(docs, capacity=64).toPandas().sort_values(["doc_id", "start"])
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for k, t in plain.items():
        ids, at = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4"), 0
        for r in got[got.doc_id == k].itertuples():
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.length.sum() <= 64 and s.offset.tolist() == np.cumsum([0, *s.length[:-1]]).tolist()


def padding(length, capacity):
    return 0 if length & (length - 1) == 0 else capacity - length


def best_cost(places, penalties, capacity):
    best = {0: 0}
    for j in range(1, len(places)):
        best[j] = min(best[i] + padding(places[j] - places[i], capacity) for i in range(j) if places[j] - places[i] <= capacity) + penalties[j]
    return best[len(places) - 1]


def test_packing_cuts_are_best():
    r = random.Random(3)
    for capacity in (20, 32):
        for _ in range(50):
            places = [0]
            while len(places) < 12:
                places.append(places[-1] + r.randint(1, 9))
            penalties = [r.randint(0, 5) for _ in places]
            cuts = packing.choose(places, penalties, capacity)
            assert sum(padding(b - a, capacity) + penalties[places.index(b)] for a, b in zip([0, *cuts], cuts)) == best_cost(places, penalties, capacity)


def test_packing_streams_give_the_whole_optimum():
    r = random.Random(4)
    packer, rows_, places, penalties = packing.Packer(64, 0, 8, block=30), [], [0], [0]
    for k in range(300):
        n = r.randint(1, 150)
        ends = np.array(sorted(r.sample(range(n), min(n, 3))))
        rows_ += packer.add(k, np.zeros(n, np.uint16), ends)
        inside = {**{i: packing.INSIDE for i in range(8, n, 8)}, **{int(e): packing.SENTENCE for e in ends if 0 < e < n}, n: 0}
        base = places[-1]
        for p in sorted(inside):
            places.append(base + p)
            penalties.append(inside[p])
    assert len(rows_) > 300  # given out before the end
    rows_ += packer.flush()
    sizes = Counter()
    for row in rows_:
        sizes[row[5]] += row[2]
    cuts = np.cumsum([sizes[k] for k in sorted(sizes)]).tolist()
    assert cuts[-1] == places[-1]
    assert sum(padding(b - a, 64) + penalties[places.index(b)] for a, b in zip([0, *cuts], cuts)) == best_cost(places, penalties, 64)


def test_fingerprints(spark, docs, plain):
    keys = sorted(plain)
    got = rows(fingerprints.fingerprint_edited(docs), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    same, errors = {}, []
    for k, after in zip(keys, [*keys[1:], keys[0]]):
        t, n = plain[k], plain[after]
        m = len(t) // 4
        edited = t[: len(t) - m] + n[:m]
        assert got[k][:2] == (len(t), sha(edited))
        assert same.setdefault(t, got[k][2]) == got[k][2]
        a, b = Counter(t.split()), Counter(edited.split())
        errors.append(got[k][4] - (sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0))
    assert abs(sum(errors) / len(errors)) < 0.1
    assert fingerprints.fingerprint_edited(empty(spark)).count() == 0
    again = spark.createDataFrame([(None, "a b"), (5, "c"), (5, "c"), (5, None)], "doc_id long, text string")
    assert fingerprints.fingerprint_edited(again).count() == 4


def test_fingerprints_of_single_documents(spark):
    r = random.Random(6)
    said, true = {}, {}
    for i in range(400):
        words = [f"{r.choice(WORDS)}{r.randint(0, 400)}" for _ in range(240)]
        changed = list(words)
        for j in r.sample(range(240), 6 if i % 2 else 27):
            changed[j] = f"new{j}"
        a, b = Counter(words), Counter(changed)
        said[2 * i], said[2 * i + 1] = " ".join(words), " ".join(changed)
        true[i] = sum((a & b).values()) / sum((a | b).values())
    df = spark.createDataFrame(list(said.items()), "doc_id long, text string")
    got = rows(fingerprints.fingerprint_edited(df), "fingerprint", "near_next")
    errors = {i: got[2 * i][1] - t for i, t in true.items()}
    assert all(abs(e) <= 4 * (true[i] * (1 - true[i]) / 64) ** 0.5 for i, e in errors.items())
    assert np.mean(np.square(list(errors.values()))) <= 1.5 * np.mean([t * (1 - t) / 64 for t in true.values()])
    # of pairs at 0.95, 4 % are alike in 64 samples, 44 % in 16
    alike = sum(got[2 * i][0] == got[2 * i + 1][0] for i in true)
    expected = sum(t**64 for t in true.values())
    assert abs(alike - expected) <= 4 * expected**0.5


def brute_samples(words, samples):
    """Consistent weighted samples of a bag of words, term by term."""
    x = fingerprints._quantiles()
    found = []
    for k in range(samples):
        least = None
        for word, n in Counter(words).items():
            term = xxhash.xxh64_intdigest(word, 42)
            h = xxhash.xxh64_intdigest(k.to_bytes(4, "little"), xxhash.xxh64_intdigest(term.to_bytes(8, "little"), 42))
            level = h >> 12 & 4095
            s = math.sqrt(((h >> 24 & (1 << 18) - 1) + 0.5) * 2 / (4096 << 18) + level * 2 / 4096)
            log_c = math.log(s) + s / 3 + s * s * 7 / 72 if level < fingerprints.LOW else math.log(x[level])
            r, b = x[h & 4095], ((h >> 42) + 0.5) / 2**22
            t = math.floor(math.log(n) / r + b)
            rank = math.floor((log_c - r * (t - b) - r + 80) * (1 << 23))
            sample = (rank, (term ^ t) & 0xFFFFFFFF)
            least = sample if least is None or sample < least else least
        found.append(f"{least[1]:08x}" if least else "0" * 8)
    return "".join(found)


def test_fingerprints_are_the_brute_force_samples(spark, docs, plain):
    got = rows(fingerprints.fingerprint_edited(docs, 8), "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    keys, own = sorted(plain), {k: brute_samples(plain[k].encode().split(), 8) for k in plain}
    share = lambda a, b: sum(a[i : i + 8] == b[i : i + 8] for i in range(0, 64, 8)) / 8
    for k, after in zip(keys, [*keys[1:], keys[0]]):
        m = len(plain[k]) // 4
        other = brute_samples((plain[k][: len(plain[k]) - m] + plain[after][:m]).encode().split(), 8)
        assert got[k] == (own[k], other, share(own[k], other), share(own[k], own[after]))
    assert rows(fingerprints.fingerprint(docs, 8), "fingerprint") == {k: (v,) for k, v in own.items()}


def test_gamma_quantiles():
    x = np.array(fingerprints._quantiles())
    assert (np.diff(x) > 0).all() and abs(x.mean() - 2) < 1e-3 and abs(x.var() - 2) < 1e-2


def test_fingerprints_odd_tables(spark):
    """Repeated rows, null ids, ties, one row, clashing columns, and a very long text."""
    said = [(None, "a b"), (None, "a b"), (5, "c"), (5, "c d"), (5, None), (9, "w x " * 200_000), (7, "")]
    df = spark.createDataFrame([(k, t, 1, "z") for k, t in said], "doc_id long, text string, bucket int, row string")
    got = fingerprints.fingerprint_edited(df).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(k) for k, _ in said)
    assert {r["n_chars"] for r in got if r["doc_id"] == 9} == {800_000}
    none = [r for r in got if r["doc_id"] is None]
    assert len({r["fingerprint"] for r in none}) == 1 and none[0]["near_next"] in (1.0, none[1]["near_next"])
    single = fingerprints.fingerprint_edited(df.filter("doc_id = 7")).collect()
    assert [(r["near_edited"], r["near_next"], r["n_chars"]) for r in single] == [(1.0, 1.0, 0)]


def test_simhash(spark, docs, plain):
    def brute(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps, root = {k: brute(t) for k, t in plain.items()}, {k: k for k in plain}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 3 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    got = rows(simhash.near_duplicates(docs), "fp", "component_id")
    assert {k: (v[0] % (1 << 64), v[1]) for k, v in got.items()} == {k: (fps[k], root[k]) for k in fps}
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_simhash_links_in_large_buckets():
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 63, dtype=np.uint64)
    fps = np.unique(base ^ (np.uint64(1) << r.integers(0, 31, 4000).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 31, 4000).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 31, 4000).astype(np.uint64)))
    simhash.LARGE, before = 256, simhash.LARGE
    try:
        parts = simhash.spread(fps, (1 << 32) - 1, simhash._references())
    finally:
        simhash.LARGE = before
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in parts:
        for x, y in zip(a.tolist(), b.tolist()):
            root[find(x)] = find(y)
    for i, f in enumerate(fps):
        for g in fps[i + 1 :][np.bitwise_count(fps[i + 1 :] ^ f) <= 3]:
            assert find(int(f)) == find(int(g))


def brute_suffix(plain):
    seen, out = set(), {}
    for k in sorted(plain):
        raw = plain[k].encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            s = raw[i : i + 100]
            if s in seen:
                gone[i : i + 100] = True
            seen.add(s)
        out[k] = (len(raw), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), sha(bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return out


def test_suffix(spark, docs, plain):
    assert rows(suffix.cut(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_suffix(plain)
    assert suffix.cut(empty(spark)).count() == 0
    again = spark.createDataFrame([(1, "q" * 99 + str(i % 2) * 150) for i in range(4)] + [(None, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] is None, r["n_removed"]) for r in suffix.cut(again).collect())
    assert len(got) == 5 and sum(n for _, n in got) > 0
    assert suffix.cut_table(again).count() == 5


def test_suffix_bounds_its_indexes(spark, monkeypatch):
    r = random.Random(8)
    line = "Licensed under the terms that the file of that name gives; all of it comes as it is, without a warranty of any kind. "
    said = {i: "".join(r.choice("abcdefgh ") for _ in range(150)) + line + "".join(r.choice("abcdefgh ") for _ in range(r.randint(0, 150))) for i in range(300)}
    said |= {300 + i: said[i][40:] for i in range(0, 300, 3)}

    class Bounded(suffix.RunIndex):
        def __init__(self, text):
            assert len(text) <= 8192 * 1.01 + 1, "an index over its bound"
            super().__init__(text)

    monkeypatch.setattr(suffix, "INDEX", 8192)
    monkeypatch.setattr(suffix, "RunIndex", Bounded)
    df = spark.createDataFrame(list(said.items()), "doc_id long, text string")
    assert rows(suffix.cut(df), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_suffix(said)


def test_run_index():
    r = np.random.default_rng(2)
    text = np.concatenate([r.integers(1, 4, 400), [0], r.integers(1, 4, 300), [0]])
    text[500:620] = text[100:220]
    length, source = suffix.RunIndex(text).statistics()
    order = sorted(range(len(text)), key=lambda i: tuple((x, 0) if x else (0, i + j) for j, x in enumerate(text[i:].tolist())))
    for a, b in zip(order, order[1:]):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n] != 0:
            n += 1
        assert length[b] == n and (n == 0 or source[b] == a)


def test_recompression(spark, docs, plain):
    count = Counter()
    split = {k: t.encode().split() for k, t in plain.items()}
    for w in split.values():
        count.update(b" ".join(w[i : i + 35]) for i in range(len(w) - 34))
    want = {}
    for k, w in split.items():
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if count[b" ".join(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        want[k] = (len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    assert rows(recompression.cut(docs), "n_words", "n_removed", "kept_sha256") == want
    assert recompression.cut(empty(spark)).count() == 0


def test_recompression_runs(spark):
    said = {1: "a " * 80, 2: "b " + "a " * 50 + "c", 3: "x y " * 40, 4: "z " + "x y " * 20, 5: " ".join(map(str, range(90)))}
    df = spark.createDataFrame(list(said.items()), "doc_id long, text string")
    assert rows(recompression.cut(df), "n_removed") == {1: (80,), 2: (50,), 3: (80,), 4: (40,), 5: (0,)}


def test_quality(spark, docs, plain):
    labels = spark.createDataFrame([(k, i % 2, 0) for i, k in enumerate(plain)], "doc_id long, quality int, toxic int")
    got = rows(quality.judge(docs, quality.train(docs, labels)), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for k, t in plain.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert got[k] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), len(w) < 10 or 100 * len(again) > 20 * len(w))
    assert quality.judge(empty(spark), quality.Field()).count() == 0


def test_quality_separates_and_decodes():
    good, bad = [3 | 1 << 16] * 6, [5 | 1 << 6 | 1 << 8] * 6
    field = quality.fit([good, bad, good + bad, good, bad], [False, True, True, False, True])
    assert field.decode(good) == [0] * 6 and field.decode(bad) == [1] * 6
    assert quality.Field().decode([1, 2, 4]) == [0, 0, 0] and field.decode([]) == []


def test_toxicity(spark):
    r = random.Random(4)
    clean = [w for w in WORDS if w != "idiot"]
    rows_ = []
    for i in range(1200):
        said = [r.choice(clean) for _ in range(r.randint(5, 80))]
        if i % 4 == 0:
            for _ in range(3):
                said.insert(r.randrange(len(said)), "idiot")
        rows_.append((i, " ".join(said), int(i % 4 == 0)))
    df = spark.createDataFrame(rows_ + [(5000, None, None), (5001, "", None)], "doc_id long, text string, toxic int")
    model = toxicity.train(df, df.select("doc_id", "toxic"))
    found = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    held = [(found[i], y) for i, _, y in rows_ if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(s >= 0.7) == (y == 1) for s, y in held]) > 0.95
    assert all(0 <= s <= 1 for s in found.values()) and found[5000] == found[5001]
    assert toxicity.reject(df, model).columns == df.columns
    assert toxicity.score(df, toxicity.train(df, df.select("doc_id", "toxic").limit(0))).first()["score"] == 0.5


def test_chat(spark):
    said = {1: [("system", "be & brief <b>"), ("user", "hi"), ("assistant", "yes <|end|>\n")], 2: [("user", None), ("assistant", "a " * 900), ("user", "b"), ("assistant", "c " * 300), ("user", "d " * 60), ("assistant", "e " * 60)], 3: [("assistant", "")]}
    df = spark.createDataFrame([(k, i, r, t, "x") for k, v in said.items() for i, (r, t) in enumerate(v)], "conv_id long, turn long, role string, text string, window string")
    windows = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.digest(windows).collect()}
    for k, v in said.items():
        loss = "".join(t or "" for r, t in v if r == "assistant")
        assert got[k]["n_turns"] == len(v) and got[k]["turns_sha256"] == sha("".join(f"{r}\n{t or ''}\n" for r, t in v))
        assert (got[k]["loss_chars"], got[k]["loss_sha256"]) == (len(loss), sha(loss))
    assert windows.filter("conv_id = 2").count() > 2
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0
    small = chat.format_conversations(df, block=2)
    assert {r["conv_id"]: r["turns_sha256"] for r in chat.digest(small).collect()} == {k: r["turns_sha256"] for k, r in got.items()}


def brute_windows(turns, budget, history, block):
    """(system and history turns, new turns) of each window, by their places in a conversation of (number, role, text)."""
    cost = lambda i: len(re.findall(r"\w+|[^\w\s]", turns[i][2])) + chat.TURN_COST
    system = turns[0][1] == "system"
    out, room, last = [], budget - (cost(0) if system else 0), None
    for i in range(system, len(turns)):
        if last and turns[i][0] // block == turns[i - 1][0] // block and sum(map(cost, range(last[0], i + 1))) <= room:
            last[2] = i + 1
            continue
        h = i
        while h > system and sum(map(cost, range(h - 1, i))) <= history:
            h -= 1
        if sum(map(cost, range(h, i + 1))) > room:
            h = i
        last = [h, i, i + 1]
        out.append(last)
    found = [(int(system) + i - h, j - h + int(system)) for h, i, j in out]
    alone = system and (len(turns) == 1 or turns[1][0] // block != turns[0][0] // block)
    return [(1, 1)] * alone + found


def test_chat_windows_are_the_brute_force_ones(spark):
    r = random.Random(9)
    said = {}
    for k in range(12):
        numbers = sorted(r.sample(range(-5, 60 if k % 2 else 3000), 40))
        said[k] = [(n, "system" if k % 3 == 0 and i == 0 else r.choice(["user", "assistant"]), "щ " * r.choice([0, 1, 3, 9, 30]) + str(n)) for i, n in enumerate(numbers)]
    df = spark.createDataFrame([(k, *t) for k, v in said.items() for t in v], "conv_id long, turn long, role string, text string")
    for budget, history, block in ((40, 16, 8), (512, 128, 1024), (30, 12, 1)):
        windows = chat.format_conversations(df, budget, history, block).orderBy("conv_id", "block", "window").collect()
        for k, turns in said.items():
            own = [w for w in windows if w["conv_id"] == k]
            assert [(w["lead"], w["n_turns"]) for w in own] == brute_windows(turns, budget, history, block)
            under = [w["formatted"][m["start"] : m["end"]] for w in own for m in w["mask"]]
            assert under == [t for _, role, t in turns if role == "assistant"]


def test_chat_odd_rows(spark):
    said = [(None, 1, "user", "a"), (None, None, "assistant", "b"), (None, None, None, None), (4, 2, "user", "x"), (4, 2, "assistant", "[INST] &lsqb; <|end|>\n"), (4, 2, "assistant", "[INST] &lsqb; <|end|>\n")]
    df = spark.createDataFrame([(*x, 1) for x in said], "conv_id long, turn long, role string, text string, block int")
    got = {r["conv_id"]: r for r in chat.digest(chat.format_conversations(df)).collect()}
    assert (got[None]["n_turns"], got[None]["loss_sha256"]) == (3, sha("b"))
    assert (got[4]["n_turns"], got[4]["loss_sha256"]) == (3, sha("[INST] &lsqb; <|end|>\n" * 2))
    assert not any("[" in w["formatted"] for w in chat.format_conversations(df).collect())


def brute_ratios(toxic, ordinary, order):
    """log P(c | context, toxic) - log P(c | context, ordinary) by the formulas, from lists of texts."""
    pad = lambda t: toxicity.BEGIN * (order - 1) + t.lower() + toxicity.END
    counts = {y: Counter(p[i : i + order] for t in said for p in [pad(t)] for i in range(len(p) - order + 1)) for y, said in ((0, ordinary), (1, toxic))}

    def loss(table):
        of = Counter(table.values())
        d = toxicity.discounts(*(of[k] for k in (1, 2, 3, 4)))
        return lambda n: d[min(n, 3) - 1] if n else 0.0

    below, types = None, set(counts[0]) | set(counts[1])
    levels = {}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in types)
        types = set(levels[k])
    for k in range(1, order):
        table, lost = levels[k], loss(levels[k])
        total, gone = Counter(), Counter()
        for g, n in table.items():
            total[g[:-1]] += n
            gone[g[:-1]] += lost(n)
        below = {g: (n - lost(n) + gone[g[:-1]] * (1 / len(table) if k == 1 else below[g[1:]])) / total[g[:-1]] for g, n in table.items()}
    out, parts = {}, []
    for y in (0, 1):
        lost, total, gone = loss(counts[y]), Counter(), Counter()
        for g, n in counts[y].items():
            total[g[:-1]] += n
            gone[g[:-1]] += lost(n)
        parts.append((counts[y], lost, total, gone))
    for g in set(counts[0]) | set(counts[1]):
        logs = []
        for table, lost, total, gone in parts:
            c = g[:-1]
            back = gone[c] / total[c] if total[c] else 1.0
            own = (table[g] - lost(table[g])) / total[c] if total[c] else 0.0
            logs.append((math.log(own + back * below[g[1:]]), math.log(back)))
        out[g], out[g[:-1]] = logs[1][0] - logs[0][0], logs[1][1] - logs[0][1]
    return out


def test_toxicity_ratios_are_the_formulas(spark):
    r = random.Random(12)
    said = [(" ".join(r.choice(WORDS) for _ in range(r.randint(0, 9))) + r.choice(["", "é", "漢字", "!"]), int(i % 3 == 0)) for i in range(60)]
    grams = toxicity.counted(spark.createDataFrame(said, "text string, toxic int"), 4)
    want = brute_ratios([t for t, y in said if y], [t for t, y in said if not y], 4)
    model = toxicity.ratios(grams, [], 4)
    assert {r_["gram"]: round(r_["ratio"], 9) for r_ in model.collect()} == {g: round(v, 9) for g, v in want.items()}
    pages = toxicity.store(model, 4)
    points, starts, ends = toxicity.code_points(["idiot the zz", ""], 4)
    got, text = pages.ratios(points), points.astype("<u4").tobytes().decode("utf-32-le")
    for i in range(3, len(points)):
        g = text[i - 3 : i + 1]
        assert abs(got[i - 3] - want.get(g, want.get(g[:-1], 0.0))) < 1e-5
    pages.pages.clear()
    assert pages.look(np.array([5], np.uint64)).tolist() != [0.0]


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(7)
    for _ in range(40):
        field = quality.Field(r.normal(size=quality.FEATURES), r.normal(size=(2, 2)))
        lines = r.integers(1, 1 << quality.FEATURES, 7).tolist()
        worth = lambda marks: sum(m * field.lean(x) for m, x in zip(marks, lines)) + sum(field.moves[a, b] for a, b in zip(marks, marks[1:]))
        paths = [[k >> i & 1 for i in range(7)] for k in range(128)]
        assert worth(field.decode(lines)) == pytest.approx(max(map(worth, paths)))


def odd_rows(spark):
    """Null and repeated ids, repeated rows, nulls everywhere, a long text, and columns that operators use inside."""
    long = " ".join(f"w{i * i % 9973}" for i in range(120_000))
    said = [(None, "a b c"), (None, "a b c"), (None, None), (4, "same words here and there"), (4, "same words here and there"), (4, "others"), (6, long), (7, "")]
    return spark.createDataFrame([(k, t, "k", "r", 1, 2) for k, t in said], "doc_id long, text string, key string, row_number string, doc_key int, kept_row int")


def test_odd_rows_in_every_operator(spark):
    df = odd_rows(spark)
    labels = spark.createDataFrame([(4, 1, 1), (None, 0, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    ids = sorted(map(str, [None, None, None, 4, 4, 4, 6, 7]))
    for out in (toxicity.score(df, toxicity.train(df, labels)), quality.judge(df, quality.train(df, labels)), simhash.near_duplicates(df), bpe.round_trip(df), recompression.cut(df), suffix.cut(df)):
        assert sorted(str(r["doc_id"]) for r in out.select("doc_id").collect()) == ids
    folder = f"{DEFAULT_SHARED}/test-records-{random.getrandbits(64)}"
    assert sorted(str(r["doc_id"]) for r in records.read(records.write(df, folder).cache(), folder).collect()) == ids
    packed = packing.pack(df).collect()
    assert {str(r["doc_id"]) for r in packed} == set(ids) and sum(r["length"] for r in packed if r["doc_id"] == 6) == {r["doc_tokens"] for r in packed if r["doc_id"] == 6}.pop()
    assert simhash.keep_one(df).columns == df.columns == suffix.cut_table(df).columns
    assert simhash.keep_one(df).count() == 5 and suffix.cut_table(df).count() == 8


def test_empty_tables_in_every_operator(spark):
    none = odd_rows(spark).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    folder = f"{DEFAULT_SHARED}/test-records-{random.getrandbits(64)}"
    for out in (toxicity.score(none, toxicity.train(none, labels)), quality.judge(none, quality.train(none, labels)), records.read(records.write(none, folder).cache(), folder), packing.pack(none), simhash.keep_one(none), suffix.cut_table(none)):
        assert out.count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "SimHash near-dedup", "suffix-array dedup", "packing"]
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and out.columns == packing.NAMES
    again = corpus_pipeline.cut_repeats(spark, spark.createDataFrame([(1, "x" * 250, "en", "s", 250)], "doc_id long, text string, lang string, source string, n_chars long"), "")
    assert again.first()["n_chars"] == len(again.first()["text"]) == 1
