"""Every stage of the pipeline against plain Python over what the stage before kept, on documents with planted cases."""

import glob
import random
import re
import zlib
from itertools import product

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import xxhash
from test_llm import brute_ratios
from tokenizers import Tokenizer

from tidewater.llm import packing, quality, toxicity
from tidewater.llm.common import shared_dir

WORDS = "the of and river stone light under garden quiet window paper seven blue walk morning lamp harbour table".split()
PASSAGE = "all rights to this text remain with its author and no part of it may be printed again without leave in writing"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def planted():
    """Rows of documents and labels, and the ids of each kind."""
    r = random.Random(21)
    say = lambda n: ".\n".join(" ".join(r.choice(WORDS) for _ in range(r.randint(6, 11))) for _ in range(n)) + "."
    texts, kinds = [], []
    for i in range(420):
        kind = ("toxic" if i % 4 == 0 else "junk" if i % 7 == 0 else "shared" if i % 10 == 1 else "clean")
        text = say(r.randint(4, 6))
        if kind == "toxic":
            words = text.split(" ")
            for _ in range(4):
                words.insert(r.randrange(len(words)), "zounderkite")
            text = " ".join(words)
        elif kind == "junk":
            text = "\n".join(" ".join(r.choice(["###", "$$", "||", "<>", "A1*", "%&", r.choice(WORDS)]) + str(r.randint(0, 999)) for _ in range(8)) for _ in range(6))
        elif kind == "shared":
            text += "\n" + PASSAGE
        texts.append(text)
        kinds.append(kind)
    for i in [k for k, v in enumerate(kinds) if v == "clean"][:40]:
        texts.append(texts[i] if i % 2 else texts[i] + " " + r.choice(WORDS))
        kinds.append("copy")
    texts += [None, "", "é 漢字 🙂", " \n\t "]
    kinds += ["short"] * 4
    docs = [(i * 5, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    labels = [(i * 5, int(k != "junk"), int(k == "toxic")) for i, k in enumerate(kinds) if k not in ("copy", "short") and i % 9]
    return docs, labels, {i * 5: k for i, k in enumerate(kinds)}


def plain_evidence(text, ratios, order):
    said = toxicity.BEGIN * (order - 1) + (text or "").lower() + toxicity.END
    grams = [said[i - order + 1 : i + 1] for i in range(order - 1, len(said))]
    v = [ratios.get(g, ratios.get(g[:-1], 0.0)) for g in grams]
    return [sum(v) / len(v), *(max(sum(v[max(0, j - w) : j]) for j in range(1, len(v) + 1)) / w for w in toxicity.WINDOWS)]


def plain_toxicity(docs, labels, order=toxicity.ORDER):
    toxic = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    known = [(row[0], row[1] or "", toxic[row[0]]) for row in docs if row[0] in toxic]
    for_curve = [(t, y) for i, t, y in known if zlib.crc32(str(i).encode()) % 6 == 5]
    counted = [(t, y) for i, t, y in known if zlib.crc32(str(i).encode()) % 6 != 5]
    ratios = brute_ratios([t for t, y in counted if y], [t for t, y in counted if not y], order)
    mean, spread, w = toxicity.fit_curve(np.array([plain_evidence(t, ratios, order) for t, _ in for_curve]), np.array([float(y) for _, y in for_curve]))
    score = lambda t: 1 / (1 + np.exp(-(((np.array(plain_evidence(t, ratios, order)) - mean) / spread) @ w[:-1] + w[-1])))
    return [row for row in docs if score(row[1]) < toxicity.THRESHOLD]


def plain_quality(docs, labels):
    good = {i: q for i, q, _ in labels}
    known = sorted((row[0], row[1] or "") for row in docs if row[0] in good)
    field = quality.fit([quality.lines_of(t.encode())[0] for _, t in known], [good[i] == 0 for i, _ in known])

    def keeps(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        again = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 5)}
        if len(words) < 10 or 100 * len(again) > 20 * len(words):
            return False
        lines, sizes, _ = quality.lines_of(text.encode())
        lean = [field.lean(x) for x in lines]
        worth = lambda marks: sum(m * x for m, x in zip(marks, lean)) + sum(field.moves[a, b] for a, b in zip(marks, marks[1:]))
        marks = max(product((0, 1), repeat=len(lines)), key=worth)
        return sum(n for n, m in zip(sizes, marks) if not m) >= quality.SHARE * len(words)

    return [row for row in docs if keeps(row[1] or "")]


def plain_near_copies(docs):
    def bits(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    found = {row[0]: bits(row[1] or "") for row in docs}
    root = {k: k for k in found}
    pairs = [(a, b) for a in found for b in found if a < b and (found[a] ^ found[b]).bit_count() <= 3]
    for _ in found:
        before = dict(root)
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    return [row for row in docs if root[row[0]] == row[0]]


def plain_cut(docs):
    seen, out = set(), []
    for doc_id, text, lang, source, n_chars in sorted(docs):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(raw[i : i + 100])
        if gone.any():
            text = bytes(np.frombuffer(raw, np.uint8)[~gone]).decode(errors="ignore")
            n_chars = len(text)
        out.append((doc_id, text, lang, source, n_chars))
    return out


def assert_packed(pieces, docs):
    library, of, sequences = Tokenizer.from_file(P.path(packing.VOCABULARY)), {}, {}
    for p in pieces:
        of.setdefault(p["doc_id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert set(of) == {row[0] for row in docs}
    for row in docs:
        ids, at = np.array([*library.encode(row[1] or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for p in sorted(of[row[0]], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), zlib.crc32(ids[at : at + p["length"]].tobytes()))
            at += p["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_every_stage_is_the_plain_one(spark, tmp_path):
    docs, labels, kinds = planted()
    folder = str(tmp_path)
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    plain = {"toxicity": lambda d: plain_toxicity(d, labels), "quality rules": lambda d: plain_quality(d, labels), "SimHash near-dedup": plain_near_copies, "suffix-array dedup": plain_cut}
    now, left = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(row) for row in now.collect()]
        path = f"{folder}/{len(left)}.parquet"
        out = stage(spark, now, folder)
        assert out.columns == now.columns
        out.write.parquet(path)
        now = spark.read.parquet(path)
        left[name] = sorted(tuple(row) for row in now.collect())
        assert left[name] == sorted(plain[name](before)), name
    kept = {name: {row[0] for row in rows} for name, rows in left.items()}
    of = lambda kind: {i for i, k in kinds.items() if k == kind}
    assert not of("toxic") & kept["toxicity"] and of("clean") | of("shared") | of("junk") <= kept["toxicity"]
    assert not (of("junk") | of("short")) & kept["quality rules"] and of("clean") | of("shared") <= kept["quality rules"]
    assert not {i for i in of("copy") if any(row[0] < i and row[1] == docs[i // 5][1] for row in docs)} & kept["SimHash near-dedup"]
    assert sum(PASSAGE in row[1] for row in left["suffix-array dedup"]) == 1 and of("clean") - kept["SimHash near-dedup"] == set()
    assert_packed(corpus_pipeline.STAGES[-1][1](spark, now, folder).collect(), left["suffix-array dedup"])
    listed = lambda: set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/table-*"))
    tables = listed()
    assert_packed(corpus_pipeline.run(spark, folder).collect(), left["suffix-array dedup"])
    assert len(listed() - tables) == 1  # what the last stage reads


def test_stages_with_odd_tables(spark, tmp_path):
    """No rows, no labels, and null ids pass all stages."""
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
    said = " ".join(WORDS) + "."
    rows = [(None, said, "en", "s", 1), (None, said, None, None, None), (3, None, None, "s", None), (4, said + " " + " ".join(reversed(WORDS)), "en", "s", 2)]
    spark.createDataFrame(rows, COLUMNS).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted({str(p["doc_id"]) for p in found}) == ["4", "None"] and sum(p["start"] == 0 for p in found) == 2
