"""Each operator against brute force on small fixtures, with nulls, empty and long texts, repeats and empty tables."""

import hashlib
import itertools
import random
import re
import unicodedata
from collections import Counter
from math import log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from wirelens.llm import chat, decontaminate, fingerprints, langid, maxent, mixing, neardup, pii, queries, token_counts, toxicity
from wirelens.llm._text import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, label int, key string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return WORD.findall(lower(t))


def frame(spark, texts, langs=None, sources=None):
    rows = [(i, t, (langs or ["en"] * len(texts))[i], (sources or ["s"] * len(texts))[i], len(t or ""), "x", 1, "k") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"{r.choice('bcdfg')}{r.choice('aeiou')}{r.randrange(vocabulary)}".translate(str.maketrans("0123456789", "lmnpqrstvw")) for _ in range(n))


ODD = [None, "", "   \t\n", "One", "É é word", "x" * 30_000, "w " * 20_000]


def base_reference(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_pii_base_equals_patterns():
    r = random.Random(1)
    bits = ["a", "b.c", "@", "a@b.co", ".", "..", "1", "12", "255", "256", "0001", "+", "+1 ", "(743) 555-3824", "4111111111111111", "-", " ", "é", "x@y@z.com", "1.2.3.4.5.6.7.8"]
    for _ in range(3000):
        t = "".join(r.choice(bits) for _ in range(r.randrange(1, 14)))
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(t)] == base_reference(t), t


def test_pii_query(spark, tmp_path):
    texts = [*ODD, "mail a.b@c.org or A.B@c.org, ip 10.0.0.1", "card 4111 1111 1111 1111 and +1 (743) 555-3824 é +1 (743) 555-3824", "phone again (743) 555-3824 later +1 (743) 555-3824"]
    docs = frame(spark, texts)
    out = {r["doc_id"]: r for r in pii.find(docs, pii.train(docs)).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        assert [(pii.KINDS[s.kind], s.start, s.stop) for s in out[i]["spans"] if s.base] == base_reference(t or "")
    masked = {r["doc_id"]: r for r in pii.mask(docs, pii.train(docs)).collect()}
    assert masked[8]["text"].count("<phone>") == 2 and masked[8]["text"].startswith("card <card> and ") and masked[8]["n_chars"] == len(masked[8]["text"])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op1_pii(spark, str(tmp_path)).collect():
        want = base_reference(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w[0] == k for w in want) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(r["spans"].split(",")) | {""}
    assert masked[0]["text"] is None and masked[5]["text"] == texts[5]
    assert pii.find(docs.limit(0), pii.train(docs.limit(0))).count() == 0


def test_skip_edges_carry_labels():
    """A mention that looks like nothing takes its twin's label over a distant skip edge; without the edge it doesn't."""
    field = pii.Field()
    field.trained = True
    field.unary[pii._bucket("5", "w"), 0] = 0
    x = pii.nodes_of(["a 5553824 b c 5553824 d"], [[]])
    assert len(x.skip) == 1 and not len(x.chain)
    field.skip[2, 2] = field.skip[0, 0] = 3.0
    field.unary[x.features[0, 0], :] = 0
    unary = field.unary.copy()
    x.features[1] = np.arange(pii.BUCKETS - pii.FEATURES, pii.BUCKETS)
    unary[x.features[0, 0], 2] = 4.0
    field.unary = unary
    tied = field.infer(x)
    x.skip = x.skip[:0]
    alone = field.infer(x)
    assert tied[1].argmax() == 2 and alone[1].max() < 0.5


def test_loopy_equals_exact_on_chains():
    rng = np.random.default_rng(0)
    field = pii.Field()
    field.trained = True
    field.unary, field.chain = rng.normal(size=field.unary.shape), rng.normal(size=field.chain.shape)
    x = pii.nodes_of(["1 22 333 4444"], [[]])
    got = field.infer(x)
    u = field.unary[x.features].sum(axis=1)
    want = np.zeros_like(got)
    for y in itertools.product(range(pii.LABELS), repeat=4):
        p = np.exp(sum(u[i, y[i]] for i in range(4)) + sum(field.chain[y[i], y[i + 1]] for i in range(3)))
        for i in range(4):
            want[i, y[i]] += p
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-6)


def test_messages_settle_in_each_document_alone():
    """A long chain gets the forward-backward marginals, whatever documents stand beside it; cycles settle too."""
    rng = np.random.default_rng(3)
    field = pii.Field()
    field.trained = True
    field.unary, field.chain, field.skip = rng.normal(size=field.unary.shape), rng.normal(size=field.chain.shape), rng.normal(size=field.skip.shape) / 4
    field.skip = field.skip + field.skip.T
    chain = " ".join(str(10**5 * (i + 1) + i) for i in range(60))
    loop = "77 1234567 x 1234567 88 y 1234567"
    x = pii.nodes_of([chain], [[]])
    u = field.unary[x.features].sum(axis=1)
    f, b = np.zeros_like(u), np.zeros_like(u)
    f[0] = u[0]
    for i in range(1, len(u)):
        f[i] = u[i] + np.log(np.exp(f[i - 1][:, None] + field.chain).sum(axis=0))
    for i in range(len(u) - 2, -1, -1):
        b[i] = np.log(np.exp(field.chain + u[i + 1] + b[i + 1]).sum(axis=1))
    p = np.exp(f + b - (f + b).max(axis=1, keepdims=True))
    alone = field.infer(x)
    assert np.allclose(alone, p / p.sum(axis=1, keepdims=True), atol=1e-6)
    both = field.infer(pii.nodes_of([loop, chain, loop], [[], [], []]))
    assert np.allclose(both[5:65], alone)
    assert np.allclose(both[:5], field.infer(pii.nodes_of([loop], [[]]))) and np.allclose(both[:5], both[65:])


def test_pii_added_spans_on_planted_mentions(spark):
    """Second mentions that the patterns miss, and numbers that are nobody's: precision and recall of the added spans."""
    r = random.Random(9)
    texts, planted, clean = [], [], []
    number = lambda n: "".join(r.choice("123456789") for _ in range(n))
    for i in range(300):
        words_ = prose(i, 60).split()
        tail = f"{number(3)}-{number(4)}"
        kind = i % 3
        first, again = [(f"+1 ({number(3)}) {tail}", tail), (f"user{number(4)}@mail.org", None), (None, f"{number(3)}-{number(4)}")][kind]
        extra = ["2024", f"{number(2)},50", f"v{number(1)}.{number(1)}"]
        if kind == 0:
            words_[10:10], words_[40:40] = [first], [again]
        elif kind == 1:
            words_[20:20] = [first]
        for e in extra:
            words_.insert(r.randrange(45, 60), e)
        texts.append(" ".join(words_))
        if kind == 0:
            at = texts[-1].rindex(tail)
            planted.append((i, at, at + len(tail)))
    docs = frame(spark, texts)
    found = {(x["doc_id"], s["start"], s["stop"]) for x in pii.find(docs, pii.train(docs)).collect() for s in x["spans"] if not s["base"]}
    hit = len(found & set(planted))
    assert hit >= 0.9 * len(planted) and hit >= 0.9 * len(found), (hit, len(planted), len(found))


def test_fingerprints_repeated_and_null_ids(spark):
    """Rows that share an id, or have none, follow each other by hash; every row has one result."""
    texts = [(5, "b"), (5, "a"), (5, "b"), (None, "n"), (None, "m"), (9, "z" * 10), *[(7, prose(i, 9)) for i in range(40)]]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    keyed = docs.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    order = sorted(keyed, key=lambda x: (-(x["doc_id"] if x["doc_id"] is not None else -(2**63)), x["h"], x["text"]))
    want = []
    for i, x in enumerate(order):
        t, nxt = x["text"], order[(i + 1) % len(order)]["text"]
        h = len(t) // 2
        want.append((str(x["doc_id"]), hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest()))
    for size in (1, 4, 1000):
        got = [(str(x["doc_id"]), x["edited_sha256"]) for x in fingerprints.edited_pairs(docs, rows_per_range=size).collect()]
        assert sorted(got) == sorted(want)


def test_fingerprints_query(spark):
    texts = [*ODD, "Ａｂ  c", "ab C", "AB\tc ", *[prose(i, 50) for i in range(12)], prose(3, 50)]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(docs).collect()}
    for split in (3, 100_000):
        again = {r["doc_id"]: r for r in fingerprints.edited_pairs(docs, rows_per_range=split).collect()}
        assert again == got
    order = sorted(range(len(texts)), reverse=True)
    for i, d in enumerate(order):
        t, nxt = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        c = lambda s: " ".join(unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", s).casefold()).split())
        r = got[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert r["near_edited"] == float(c(e) == c(t)) and r["near_next"] == float(c(nxt) == c(t))
    assert got[7]["fingerprint"] == got[8]["fingerprint"] == got[9]["fingerprint"] != got[10]["fingerprint"]
    assert got[len(texts) - 1]["fingerprint"] == got[13]["fingerprint"]
    assert fingerprints.fingerprint_edits(docs.limit(0)).count() == 0
    groups = {r["doc_id"]: r["group_id"] for r in fingerprints.exact_groups(docs).collect()}
    assert groups[9] == 7 and groups[len(texts) - 1] == 13 and groups[2] == 0


def test_fingerprint_collisions_are_told_apart(spark, monkeypatch):
    docs = spark.createDataFrame([(0, "one"), (1, "two"), (2, "ONE"), (2, "two"), (None, "one")], "doc_id long, text string")
    keep = fingerprints.with_digest
    monkeypatch.setattr(fingerprints, "with_digest", lambda d, b, **k: keep(d, b, **k).withColumn("digest", fingerprints.F.lit("same")))
    assert fingerprints.clashes(docs) == {"same"}
    odd = frozenset(keep(docs, False).select("digest").toPandas()["digest"])
    monkeypatch.setattr(fingerprints, "clashes", lambda d: odd)
    groups = {(r["doc_id"], r["fingerprint"]): r["group_id"] for r in fingerprints.exact_groups(docs).collect()}
    assert len(groups) == 5 and len({f for _, f in groups}) == 2 and all(len(f) == 32 + 1 + 64 for _, f in groups)
    got = fingerprints.fingerprint_edits(docs).collect()
    assert len(got) == 5 and {r["fingerprint"] for r in got} == {f for _, f in groups}


def test_chat(spark):
    assert all(chat.unescape(chat.escape(t)) == t for t in ["", "\\", "<|", "<\\|", "</s>[INST] ok [/INST]", "\\\\<|end|>\n", "<<s>", "<|\\"])
    for t in ("</s>[INST] ok [/INST]", "<|end|>"):
        assert not any(c in chat.escape(t) for c in chat.CONTROLS)
    turns = [(1, 1, "assistant", "b<"), (1, 0, "user", None), (2, 0, None, "hi"), (2, 0, "assistant", "\\<|end|>"), *[(3, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(40)]]
    df = spark.createDataFrame([(*t, 5) for t in turns], "conv_id long, turn long, role string, text string, n int")
    got = {r["conv_id"]: r for r in chat.format_digests(df).collect()}
    for c in (1, 2, 3):
        mine = sorted([(t[1], t[2] or "", t[3] or "") for t in turns if t[0] == c])
        loss = "".join(t for _, r, t in mine if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in mine).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and got[c]["loss_chars"] == len(loss)
        assert got[c]["formatted_chars"] == len(chat.marked_turns([{"role": r, "text": t} for _, r, t in mine]))
        assert got[c]["rewrites"] == 0
    spans = sorted((r for r in chat.format_turns(df).collect() if r["conv_id"] == 3), key=lambda r: r["n"])
    whole = "".join(r["span"] for r in spans)
    assert all(whole[r["content_start"] : r["content_end"]] == f"t{r['n']}" for r in spans)
    assert chat.format_digests(df.limit(0)).count() == 0


def test_chat_detects_rewriting(spark):
    def thoughts_go(messages):  # drops a mark from all but the last message
        return "".join(f"[{m['role']}]{m['text']}{'!' if i == len(messages) - 1 else ''};" for i, m in enumerate(messages))

    df = spark.createDataFrame([(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "a")], "conv_id long, turn long, role string, text string")
    got = sorted((r["conv_id"], r["n"], r["rewrites"]) for r in chat.format_turns(df, thoughts_go).collect())
    assert got == [(1, 0, False), (1, 1, True), (2, 0, False)]


def test_chat_renders_whole_prefixes(spark):
    """Templates that number turns, or change the first turn late, in conversations of 40 turns."""

    def numbered(messages):
        return "".join(f"{i}:{m['text']};" for i, m in enumerate(messages))

    def forgets(messages):  # from 12 turns on the first one is summarised
        return "".join("[old];" if i == 0 and len(messages) >= 12 else f"{m['text']};" for i, m in enumerate(messages))

    df = spark.createDataFrame([(1, i, "u", f"t{i}") for i in range(40)], "conv_id long, turn long, role string, text string")
    messages = [{"role": "u", "text": f"t{i}"} for i in range(40)]
    for template, rewriting in ((numbered, []), (forgets, [11])):
        rows = sorted(chat.format_turns(df, template).collect(), key=lambda r: r["n"])
        assert [r["n"] for r in rows if r["rewrites"]] == rewriting
        whole = ""
        for r in rows:
            whole = whole[: r["start"]] + r["span"]
        assert whole == template(messages)
        assert all(whole[r["content_start"] : r["content_end"]] == f"t{r['n']}" for r in rows if r["n"] not in rewriting and r["n"] > 11 or not rewriting)


@pytest.mark.parametrize("late", [12, 90])
def test_chat_catches_false_declarations(spark, monkeypatch, late):
    """A template says that it doesn't look back, and rewrites the first turn later on."""

    def lies(messages):
        return "".join("[old];" if i == 0 and len(messages) > late else f"{m['text']};" for i, m in enumerate(messages))

    lies.looks_back = 0
    df = spark.createDataFrame([(c, i, "u", f"t{i}") for c, n in ((1, 100), (2, 5), (3, 70)) for i in range(n)], "conv_id long, turn long, role string, text string")
    got = {}
    for r in sorted(chat.format_turns(df, lies).collect(), key=lambda r: (r["conv_id"], r["n"])):
        got.setdefault(r["conv_id"], []).append(r)
    assert {c: [r["n"] for r in rows if r["rewrites"]] for c, rows in got.items()} == {1: [late], 2: [], 3: [late] if late < 70 else []}
    for rows in got.values():
        whole = ""
        for r in rows:
            whole = whole[: r["start"]] + r["span"]
        assert whole == lies([{"text": f"t{i}"} for i in range(len(rows))])


def test_chat_long_conversations_are_rendered_as_declared(monkeypatch):
    """From WHOLE_TURNS turns on a true declaration saves rendering, and gives what whole prefixes give; what isn't held any more isn't compared."""
    r, seen = random.Random(8), []

    def template(messages):
        seen.append(len(messages))
        return chat.marked_turns(messages)

    rows = [{"conv_id": 1, "role": r.choice(["user", "assistant"]), "text": prose(i, 4)} for i in range(200)]
    batch = [pa.RecordBatch.from_pylist(rows)]
    whole = [x for *_, x in chat._stream(batch, template)]
    assert max(seen) == 200 and sum(seen) > 10_000
    template.looks_back = 0
    for most in (chat.VERIFIED_CHARS, 2000):
        monkeypatch.setattr(chat, "VERIFIED_CHARS", most)
        seen.clear()
        out = list(chat._stream(batch, template))
        assert [x for *_, x in out] == whole and [f for _, f, *_ in out] == [True] + [False] * 199 and sum(seen) < 10_000


def test_chat_local_template_equals_whole_rendering():
    r = random.Random(5)
    turns = [(r.choice(["user", "assistant", "\ue000\ue001", ""]), r.choice(["", "\ue000\ue001\ue001", "a<|b", "\\", prose(i, 5)])) for i in range(60)]
    local, whole = chat.Renderer(chat.marked_turns), chat.Renderer(lambda m: chat.marked_turns(m))
    assert local.most == 1 and whole.most is None
    for role, text in turns:
        a, b = local.add(role, text), whole.add(role, text)
        assert a == b and a["located"] and chat.unescape(a["content"]) == text and chat.read_role(a["head"]) == role


def test_token_scan(spark, tmp_path):
    rng = np.random.default_rng(3)
    want = {}
    for name, lens, tail in (("a", [0, 3, 700, 0, 5, 64, 63], 0), ("b", [1] * 50, 9), ("c", [5000], 0)):
        ids = []
        for n in lens:
            ids += [*rng.integers(0, 100, n), 999]
        ids += [1] * tail
        np.array(ids, dtype="<u2").tofile(tmp_path / f"{name}.bin")
        want[name] = [*lens, *([tail] if tail else [])]
    (tmp_path / "empty.bin").touch()
    for block in (1, 7, 64, 10_000):
        rows = token_counts.scan(token_counts.read_flat(spark, str(tmp_path), block), 999).collect()
        got = {}
        for r in sorted(rows, key=lambda r: r["ordinal"]):
            got.setdefault(r["file"].rsplit("/", 1)[1][0], []).append(r["n_tokens"])
        assert got == want
        assert sum(not r["closed"] for r in rows) == 1


def test_token_scan_stitches_summaries_only(spark, capsys):
    """The window over a file's blocks sees no list of separators."""
    df = spark.createDataFrame([("f", 0, bytearray(b"\0\0"))], token_counts.BLOCK_SCHEMA)
    plan = token_counts.scan(df, 0)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window" in line:
            assert "places" not in line
    assert [r["n_tokens"] for r in token_counts.scan(df, 0).collect()] == [0]


def test_wide_identifiers(spark):
    docs = frame(spark, ["a b", "c"])
    wide = token_counts.document_counts(docs, queries.TOKENIZER_RANKS, separator=70_000, width=4)
    assert {r["doc_id"]: r["n_tokens"] for r in wide.collect()} == {0: 2, 1: 1}


def test_token_counts(spark):
    texts = [*ODD[:5], *[prose(i, 300) for i in range(8)], prose(99, 9000), "it's a test of 12 words, isn't it? " * 900]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.document_counts(docs, queries.TOKENIZER_RANKS, block_tokens=256).collect()}
    encode = token_counts._encoding(queries.TOKENIZER_RANKS).encode_ordinary
    assert got == {i: len(encode(t or "")) for i, t in enumerate(texts)}
    assert token_counts.document_counts(docs.limit(0), queries.TOKENIZER_RANKS).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_decontamination_recall(spark):
    r = random.Random(7)
    items = [prose(1000 + i, r.choice([5, 7, 9, 16, 25, 40, 59])) for i in range(60)]
    texts, planted = [*ODD], set()
    for n in range(240):
        i = n % 60
        w = items[i].split()
        for _ in range(r.randrange(0, int(0.2 * len(w)) + 1)):
            at, kind = r.randrange(len(w)), r.randrange(3)
            w[at : at + (kind < 2)] = [] if kind == 0 and len(w) > 4 else [f"new{r.randrange(9999)}"]
        texts.append(f"{prose(5000 + n, r.randrange(60))} {' '.join(w).upper()}. {prose(9000 + n, r.randrange(60))}")
        if distance([x for x in w], items[i].split()) <= int(0.2 * len(items[i].split())):
            planted.add((len(texts) - 1, i))
    clean_from = len(texts)
    texts += [prose(20_000 + n, 200) for n in range(60)]
    docs = frame(spark, texts)
    bench = spark.createDataFrame([*enumerate(items), (900, None), (901, ""), (902, "never there")], "item_id long, text string")
    found = decontaminate.find_leaks(docs, bench).collect()
    pairs = {(f["doc_id"], f["item_id"]) for f in found}
    assert len(planted & pairs) >= 0.98 * len(planted)
    assert not any(d >= clean_from for d, _ in pairs)
    for f in found:  # every hit verifies
        w = [x for x in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower(texts[f["doc_id"]])) if x]
        assert distance(items[f["item_id"]].split(), w[f["start_word"] : f["start_word"] + f["n_words"]]) == f["edits"] <= 0.2 * len(items[f["item_id"]].split())
    blocks = decontaminate.find_leaks(docs, bench, block_items=25)
    assert {(f["doc_id"], f["item_id"]) for f in blocks.collect()} == pairs
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0 == decontaminate.find_leaks(docs.limit(0), bench).count()
    assert decontaminate.drop_leaks(docs, bench).count() == len(texts) - len({d for d, _ in pairs})


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 12, 30, 80, 200])
def test_decontamination_recall_by_length(n):
    """All allowed edits at the start, at the end, in one block, spread, as every second word; replaced, dropped, inserted."""
    r, k, texts, items = random.Random(n), int(0.2 * n), [], []
    fresh = lambda: f"z{r.randrange(10**9)}"
    for i in range(60):
        w = [f"i{i}w{j}" for j in range(n)]
        items.append(" ".join(w))
        at = {0: range(k), 1: range(n - k, n), 2: range((n - k) // 2, (n - k) // 2 + k), 3: [j * n // max(1, k) for j in range(k)], 4: [2 * j for j in range(k)], 5: [n - 1 - 2 * j for j in range(k)]}[i % 6]
        kind = i // 6 % 3
        w = [x for j, v in enumerate(w) for x in ((v,) if j not in at else ((fresh(),), (), (fresh(), v))[kind])]
        texts.append(" ".join([fresh() for _ in range(r.randrange(3 * n + 5))] + w + [fresh() for _ in range(r.randrange(3 * n + 5))]))
    hashed = [Words(pa.array([t])).hashes() for t in items]
    index = decontaminate.Index([(i, n) for i in range(60)], hashed, 0.2, 40, 3, 5)
    found = decontaminate._verified(pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": texts}), index, "doc_id", "text")
    pairs = set(zip(found.column("doc_id").to_pylist(), found.column("item_id").to_pylist()))
    assert len({(i, i) for i in range(60)} & pairs) >= 59 and all(d == i for d, i in pairs)


def test_decontamination_short_and_unnamed_items(spark):
    docs = frame(spark, ["say hello world now", "hello", "World, hello", None, "hello world; hello world"])
    bench = spark.createDataFrame([(1, "Hello world"), (None, "say"), (None, "now"), (4, "hello world now then")], "item_id long, text string")
    got = sorted((f["doc_id"], str(f["item_id"]), f["start_word"], f["n_words"], f["edits"]) for f in decontaminate.find_leaks(docs, bench).collect())
    assert got == [(0, "1", 1, 2, 0), (0, "None", 0, 1, 0), (0, "None", 3, 1, 0), (4, "1", 0, 2, 0)]


def test_language_id_is_the_smallest_compression(spark):
    """Sizes restated by compressing every chunk with every dictionary, one text of many chunks and short ones."""
    import zstandard

    docs = frame(spark, [*ODD, "der die das und ist nicht", "the of and to in is", *[prose(i, n) for i, n in enumerate((3, 60, 399, 401, 3000))]], ["en", "fr", "en", "en", "fr", "de", "de", "de", "en", *["xx"] * 5])
    model = langid.train(docs)
    made = {k: zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False) for k, d in model.languages.items()}
    for x in langid.identify(docs, model).join(docs, "doc_id").collect():
        t = re.sub(r"[^\W\d_]", lambda m: m[0].lower(), x["text"] or "")
        t = re.sub(r"(?:[\W\d_])+", " ", t).encode()
        if not t.strip():
            assert x["lang_pred"] == "und"
            continue
        size = {k: sum(len(c.compress(t[i : i + 1500])) for i in range(0, len(t), 1500)) for k, c in made.items()}
        least = min(size.values())
        assert size[x["lang_pred"]] == least and list(model.languages).index(x["lang_pred"]) == min(i for i, k in enumerate(model.languages) if size[k] == least)
        rest = sorted(size.values())
        assert x["margin"] == pytest.approx((rest[1] - rest[0]) / rest[0])


def test_language_id(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    apart = queries.held_out(5, 0)
    got = langid.identify(docs, langid.train(docs.filter(~apart))).join(docs, "doc_id").filter(apart).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    odd = frame(spark, [None, "", " 12 34 !", "é", "the the"], [None, "en", "en", "fr", "en"])
    out = {r["doc_id"]: r["lang_pred"] for r in langid.identify(odd, langid.train(odd)).collect()}
    assert [out[i] for i in range(3)] == ["und"] * 3 and out[3] in ("en", "fr")
    assert {r["lang_pred"] for r in langid.identify(odd, langid.train(odd.filter("lang is null"))).collect()} == {"und"}
    assert langid.identify(odd.limit(0), langid.train(odd)).count() == 0
    assert sorted(r["doc_id"] for r in langid.keep_identified(odd, 0.0).collect()) == [3, 4]


def test_maxent_base_is_exact(spark, monkeypatch):
    texts = [*ODD, *[prose(i, 80, 60) for i in range(30)], prose(3, 80, 60)]
    docs = frame(spark, texts)
    apart = [crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    count = Counter(w for i, t in enumerate(texts) if not apart[i] for w in [*words(t), "\n"])
    n, v = sum(count.values()), len(count)
    results = []
    for frequent in (400_000, 5):  # all words frequent, and nearly all by the join
        monkeypatch.setattr(maxent, "FREQUENT", frequent)
        got = {r["doc_id"]: r for r in maxent.scores(docs, queries.held_out(7, 2)).collect()}
        for i, t in enumerate(texts):
            tokens = [*words(t), "\n"]
            assert (got[i]["n_tokens"], got[i]["train_tokens"], got[i]["held_out"]) == (len(tokens), n, apart[i])
            assert got[i]["n_known"] == sum(w in count for w in tokens)
            assert got[i]["base_score"] == pytest.approx(sum(log10((count[w] + 1) / (n + v + 1)) for w in tokens), rel=1e-9)
        results.append({i: r["score"] for i, r in got.items()})
    assert results[0] == pytest.approx(results[1], rel=1e-6)
    assert maxent.scores(docs.limit(0), queries.held_out(7, 2)).count() == 0


def test_maxent_scores_are_normalised_probabilities(spark):
    """Scores restated token by token from the model's weights; the probabilities of all training words and of an unseen
    word of each last class sum to 1 after any history."""
    texts = [*[prose(i, 60, 30) for i in range(25)], None, "", "a never seen word", "A b\tC a b"]
    docs = frame(spark, texts)
    apart = queries.held_out(7, 2)
    model = maxent.train(docs.filter(~apart))[0].model
    got = {r["doc_id"]: r["score"] for r in maxent.scores(docs, apart).collect()}
    vocabulary = maxent.Sequence(pa.array([t for i, t in enumerate(texts) if crc32(str(i).encode()) % 7 != 2]))
    keys, counts = np.unique(vocabulary.keys, return_counts=True)
    leaf_tokens, leaf_words = np.zeros(maxent.LEAVES), np.zeros(maxent.LEAVES)
    np.add.at(leaf_tokens, (keys & maxent._CODE).astype(int), counts)
    np.add.at(leaf_words, (keys & maxent._CODE).astype(int), 1)
    count = dict(zip(keys.tolist(), counts.tolist()))

    def log10_leaf(history, code):
        out = 0.0
        for level in range(maxent.LEVELS):
            above, mine = code >> maxent.BITS * (maxent.LEVELS - level), code >> maxent.BITS * (maxent.LEVELS - 1 - level) & (maxent.WAYS - 1)
            inside = (leaf_tokens + leaf_words + maxent.UNSEEN).reshape(maxent.WAYS**level, maxent.WAYS, -1)[above].sum(axis=1)
            s = np.log(inside / inside.sum())
            for x in model.places([np.array([h]) for h in history], np.array([above]), level):
                s = s + model.weights[int(x[0])]
            out += s[mine] - np.log(np.exp(s).sum())
        return out / np.log(10)

    for i in (0, 4, 25, 26, 27, 28):
        seq = maxent.Sequence(pa.array([texts[i]]))
        history = list(zip(*seq.features()))
        want = 0.0
        for h, key in zip(history, seq.keys.tolist()):
            code = key & (maxent.LEAVES - 1)
            want += log10_leaf(h, code) + log10((count[key] + 1 if key in count else maxent.UNSEEN) / (leaf_tokens[code] + leaf_words[code] + maxent.UNSEEN))
        assert got[i] == pytest.approx(want, rel=1e-5)
    codes = np.arange(maxent.LEAVES)
    inside = np.zeros(maxent.LEAVES)
    for key, n in count.items():
        inside[key & (maxent.LEAVES - 1)] += (n + 1) / (leaf_tokens[key & (maxent.LEAVES - 1)] + leaf_words[key & (maxent.LEAVES - 1)] + maxent.UNSEEN)
    inside += maxent.UNSEEN / (leaf_tokens + leaf_words + maxent.UNSEEN)
    assert np.allclose(inside, 1)
    for h in history[:3]:
        leaf = 10 ** model.log10_classes([np.full(len(codes), x, np.uint64) for x in h], codes)
        assert leaf.sum() == pytest.approx(1, abs=1e-4) and (leaf * inside).sum() == pytest.approx(1, abs=1e-4)
    assert np.abs(model.weights).max() > 0.1


def test_maxent_sums_as_a_tree(spark):
    n = 3 * maxent.CHUNK
    rows = [(p, c, bytearray(np.full(maxent.CHUNK, p + c, np.float32).tobytes())) for p in range(10) for c in range(3)]
    got = maxent.total(spark.createDataFrame(rows, maxent.SUMS), n, fan=2)
    assert got.reshape(3, -1).mean(axis=1).tolist() == [45.0, 55.0, 65.0] and got.std() > 0


def test_maxent_learns_from_history(spark, sf):
    """On held-out text the model beats the base, and more rounds beat fewer."""
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    result = []
    for rounds in (1, 2):
        got = maxent.scores(docs, queries.held_out(7, 2), rounds).filter("held_out").agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
        result.append((got["sum(score)"] - got["sum(base_score)"]) / got["sum(n_tokens)"])
    assert result[0] < result[1] and result[1] > 0.02


def components_by_force(texts, percent, width=5):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    label = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        x = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * x >= percent * (len(sets[a]) + len(sets[b]) - x):
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = [new if c == old else c for c in label]
    return [len(s) for s in sets], label


def edited(t, r, share):
    w = t.split()
    for _ in range(int(share * len(w))):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, percent):
    r = random.Random(2)
    texts = [*ODD, "One", "a b c d", "A b C d", "a b c d e f g h i j k l", "a b c d e f g h i j k"]
    for g in range(12):
        t = prose(g, r.choice([8, 30, 120, 400]))
        texts += [t, t.upper(), *[edited(t, r, r.choice([0, 0.005, 0.01, 0.02, 0.03, 0.04])) for _ in range(8)]]
    chain = prose(77, 300).split()  # each links with the next only
    texts += [" ".join(chain[i * 14 : i * 14 + 160]) for i in range(9)]
    sizes, label = components_by_force(texts, percent)
    got = {x["doc_id"]: x for x in neardup.near_duplicates(frame(spark, texts), percent=percent).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [got[i]["component_id"] for i in range(len(texts))] == label
    assert all(got[i]["kept"] == (label[i] == i) for i in got)


def test_near_duplicates_small_groups_beside_a_large_one(spark):
    """Groups that share a long passage meet in buckets without linking; each still finds its own links."""
    r = random.Random(8)
    shared, texts = prose(500, 300), []
    for g in range(20):
        own = f"{shared} {prose(600 + g, 60)}"
        texts += [edited(own, r, 0.006) for _ in range(60 if g == 0 else 2)]
    sizes, label = components_by_force(texts, 85)
    got = {x["doc_id"]: x["component_id"] for x in neardup.near_duplicates(frame(spark, texts)).collect()}
    assert len(set(label)) == 20
    assert [got[i] for i in range(len(texts))] == label


def test_near_duplicates_links_inside_a_hot_group_under_the_threshold(spark):
    """Texts of one template just under the threshold to each other share buckets; a few pairs among them link."""
    r = random.Random(31)
    base, texts = prose(31, 1200, 9000).split(), []
    for i in range(200):
        if i not in (60, 130):
            own = {p * 100 + r.randrange(100): f"own{i}x{p}" for p in range(12)}
        else:
            own = dict(list(own.items())[:3]) | {p * 100 + r.randrange(100): f"own{i}x{p}" for p in range(3, 12)}
        texts.append(" ".join(own.get(k, w) for k, w in enumerate(base)))
    sets = [{hash(x) for x in zip(*(words(t)[k:] for k in range(5)))} for t in texts]
    low = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both) and low[a] != low[b]:
            x, y = sorted((low[a], low[b]))
            low = [x if v == y else v for v in low]
    assert 2 <= len(texts) - len(set(low)) <= 6
    got = {x["doc_id"]: x["component_id"] for x in neardup.near_duplicates(frame(spark, texts)).collect()}
    assert got == dict(enumerate(low))


def test_near_duplicates_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "q r s t u v"), (2, "A B c d e f"), (3, None)], "doc_id long, text string")
    got = sorted((str(x["doc_id"]), x["component_id"], x["kept"]) for x in neardup.near_duplicates(docs).collect())
    assert got == [("1", 1, True), ("1", 1, True), ("2", 1, False), ("3", 3, True), ("None", None, False)]
    assert sorted(str(x["doc_id"]) for x in neardup.drop_near_duplicates(docs).collect()) == ["1", "3", "None"]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_one_link_among_texts_under_the_threshold(spark):
    """Groups in which nearly all pairs are at similarity 0.844 and few at 0.8513: no bucket's members are all centres."""
    texts = []
    for seed in range(10):
        r = random.Random(seed)
        n, own = 652, 55  # shingles of a text, those of its own words
        base, spots = [f"s{seed}w{k}" for k in range(n + 4)], list(range(2, n, 5))
        for i in range(40):
            mine = set(r.sample(spots, own // 5))
            texts.append(" ".join(f"s{seed}x{i}y{k}" if k in mine else w for k, w in enumerate(base)))
        twin = texts[-20].split()
        for k in r.sample([k for k in spots if "x" not in twin[k]], 10):
            twin[k] = f"s{seed}twin{k}"
        texts.append(" ".join(twin))
    label = []
    for seed in range(10):
        label += [x + 41 * seed for x in components_by_force(texts[41 * seed : 41 * seed + 41], 85)[1]]
    got = {x["doc_id"]: x["component_id"] for x in neardup.near_duplicates(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == label and 10 <= len(texts) - len(set(label)) <= 60


def test_near_duplicates_prefix_join_alone_is_exact(spark):
    """Without star rounds the closing join finds the same components."""
    r = random.Random(12)
    texts = []
    for g in range(10):
        t = prose(g, r.choice([12, 40, 150]))
        texts += [edited(t, r, r.choice([0.005, 0.01, 0.02, 0.03])) for _ in range(7)]
    sizes, label = components_by_force(texts, 85)
    for rounds in (0, 1):
        got = {x["doc_id"]: x["component_id"] for x in neardup.near_duplicates(frame(spark, texts), rounds=rounds).collect()}
        assert [got[i] for i in range(len(texts))] == label


def test_near_duplicates_deals_hot_buckets_and_centres(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HOT", 5)
    monkeypatch.setattr(neardup, "FAN", 4)
    r = random.Random(3)
    texts = [edited(prose(1, 200), r, r.choice([0.005, 0.02, 0.04])) for _ in range(60)]
    sizes, label = components_by_force(texts, 85)
    got = {x["doc_id"]: x["component_id"] for x in neardup.near_duplicates(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == label


def test_near_duplicates_join_sets_plainly_unless_nodes_are_hot(spark, monkeypatch):
    """Only a side with hot nodes is dealt; every plan stays in the driver's memory."""
    known = spark.createDataFrame([(i, 10 * i) for i in range(9)], "node long, n long")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 7)] + [(7, 8), (1, 2)], "a long, b long")
    want = sorted((a, b, 10 * a, 10 * b) for a, b in pairs.collect())
    for fan, dealt in ((500, 0), (4, 1), (1, 2)):
        monkeypatch.setattr(neardup, "FAN", fan)
        got = neardup._with_sets(pairs, known, ["n"])
        assert sorted(map(tuple, got.select("a", "b", "na", "nb").collect())) == want
        assert got._jdf.queryExecution().analyzed().toString().count("Generate explode(sequence") == dealt
    assert neardup._with_sets(pairs.limit(0), known, ["n"]) is None


def test_near_duplicates_large_buckets_begin_with_the_node_amid_the_group(spark, monkeypatch):
    """Node 9 is in every large bucket, so all have it as their centre, whatever its hash."""
    monkeypatch.setattr(neardup, "LARGE", 2)
    bands = {9: [0] * 6, **{i: [0 if b == i % 6 or b == i // 6 % 6 else 1000 * i + b for b in range(6)] for i in range(10, 46)}}
    nodes = spark.createDataFrame([(i, 50, x) for i, x in bands.items()], "node long, n long, bands array<long>")
    members = neardup._labelled(neardup._buckets(nodes), None)
    found = neardup._open_buckets(members).collect()
    assert len(found) == 6 and {x["a"] for x in found} == {9}
    assert sorted(x["size"] for x in found) == sorted(sum(x[b] == 0 for x in bands.values()) for b in range(6))


def test_near_duplicates_exact_join_counts_shingles_of_one_component_as_unshared(spark):
    """Two components whose sets share 88 of 100 shingles, a rare one among them, and have 10 of their component each."""
    sets = {}
    for i in range(6):
        for side in (0, 6):
            sets[side + i] = [*range(100, 187), 200 + i, *range(300 + side * 10, 310 + side * 10), 1000 + 2 * (side + i), 1001 + 2 * (side + i)]

    def pairs(sets: dict, label: dict) -> set:
        known = spark.createDataFrame([(i, len(x), sorted(x)) for i, x in sets.items()], "node long, n long, shingles array<long>")
        return {tuple(sorted(x)) for x in neardup._prefix_pairs(spark.createDataFrame(list(label.items()), "node long, label long"), known, 85).collect()}

    label = {i: i // 6 for i in sets}
    assert pairs(sets, label) == set()
    # A third set that links with the first component is still met.
    assert {(i, 12) for i in range(6)} <= pairs(sets | {12: sets[0][:-2] + [9000, 9001]}, label | {12: 12})


def test_components_end_without_a_confirming_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(neardup, "cut", lambda df, cut=neardup.cut: written.append(1) or cut(df))
    r = random.Random(4)
    chain = list(range(20, 40))
    r.shuffle(chain)
    many = [*zip(chain, chain[1:]), *[(r.randrange(50, 90), r.randrange(50, 90)) for _ in range(30)]]
    for edges, most in (([(1, 2), (5, 4), (9, 3)], 2), ([(3, 1), (3, 2), (3, 8), (1, 3)], 3), (many, 12)):
        low = {v: v for e in edges for v in e}
        for _ in low:
            for a, b in edges:
                low[a] = low[b] = min(low[a], low[b])
        written.clear()
        got = dict(map(tuple, neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()))
        assert got == low and len(written) <= most


def test_near_duplicates_repeated_ids(spark):
    a, b = "a b c d e f", "q r s t u v"
    docs = spark.createDataFrame([(3, a, 1), (7, a, 2), (7, b, 1), (9, b, 1), (11, None, 1), (11, "k l m n o", 1), (12, "k l m n o", 1), (3, "other words of this one document", 5), (3, a, 0), (None, a, 1), (None, "z z z z z z", 1)], "doc_id long, text string, n int")
    got = neardup.near_duplicates(docs.filter("doc_id is not null")).collect()
    assert {(x["doc_id"], x["component_id"]) for x in got} == {(3, 3), (7, 3), (9, 3), (11, 11), (12, 11)} and len(got) == 9
    kept = sorted((x["doc_id"], x["text"] or "", x["n"]) for x in neardup.drop_near_duplicates(docs.filter("doc_id is not null")).collect())
    assert kept == [(3, a, 0), (3, "other words of this one document", 5), (11, "", 1), (11, "k l m n o", 1)]
    assert neardup.drop_near_duplicates(docs).filter("doc_id is null").count() == 2


def test_forward_backward(monkeypatch):
    monkeypatch.setattr(toxicity, "PART", 2)
    rng = np.random.default_rng(1)
    lens = [4, 1, 0, 5]
    first = np.concatenate([[0], np.cumsum(lens)])
    odds, move, start = np.exp(rng.normal(size=sum(lens))), np.exp(rng.normal(size=(2, 2))), 0.7
    got = toxicity.marginals(odds, first, move, start)[0]
    want = np.zeros(sum(lens))
    for i, n in enumerate(lens):
        total, one = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            p = 1.0
            for t in range(n):
                p *= odds[first[i] + t] ** y[t] * ((start if y[t] else 1.0) if t == 0 else move[y[t - 1], y[t]])
            total += p
            one += p * np.array(y)
        if n:
            want[first[i] : first[i + 1]] = one / total
    assert np.allclose(got, want)


def test_toxicity(spark):
    r = random.Random(4)
    bad = ["grubble", "snarkel", "vomton"]
    texts, toxic = [], []
    for i in range(400):
        w = prose(i, r.randrange(20, 120), 40).split()
        if i % 5 == 0:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(bad))
        texts.append("É " + " ".join(w))
        toxic.append(int(i % 5 == 0))
    docs = frame(spark, [*texts, None, "", "w " * 30_000 + "snarkel grubble vomton snarkel grubble", "x" * 30_000])
    labels = spark.createDataFrame([(i, t, 1) for i, t in enumerate(toxic)] + [(0, None, 1), (5000, 1, 0)], "doc_id long, toxic int, quality int")
    apart = queries.held_out(5, 0)
    model = toxicity.train(docs.filter(~apart), labels)
    got = {x["doc_id"]: x for x in toxicity.score(docs, model).collect()}
    held = [i for i in range(400) if crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i]["score"] >= 0.5) == toxic[i] for i in held]) > 0.97
    for i in held:
        for s in got[i]["toxic_spans"]:
            assert texts[i][s["start"] : s["stop"]] in bad
    assert 0 <= got[400]["score"] == got[401]["score"] < 0.5
    assert [s["start"] for s in got[402]["toxic_spans"]][0] == 60_000 and got[402]["score"] > 0.5 > got[403]["score"]
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert {x["score"] for x in toxicity.score(docs, toxicity.train(docs, labels.limit(0))).collect()} == {0.0}


def targets_by_force(sizes, weights, cap):
    target, open_ = {}, set(sizes)
    left = sum(sizes.values())
    while open_:
        unit = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if unit * weights[s] > cap * sizes[s]}
        if not over:
            return target | {s: unit * weights[s] for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing(spark):
    r = random.Random(6)
    names = ["é", "a", "Z", "b", None, "tiny", "hot", "empty"]
    sources = [r.choice(names[:5]) if i % 3 else "hot" for i in range(600)] + ["tiny"] * 2 + ["empty"] * 3
    texts = [prose(i, r.randrange(1, 200)) for i in range(600)] + ["one two"] * 2 + [None, "", " "]
    docs = frame(spark, texts, sources=sources)
    got = {x["doc_id"]: x for x in mixing.mix_sources(docs).collect()}
    sizes = {}
    for s, t in zip(sources, texts):
        sizes[s] = sizes.get(s, 0) + len(words(t))
    order = sorted([s for s in sizes if s is not None]) + [None]
    want = targets_by_force(sizes, {s: float(i % 3 + 1) for i, s in enumerate(order)}, 3)
    taken = Counter()
    for i, s in enumerate(sources):
        x = got[i]
        assert (x["size"], x["source_size"]) == (len(words(texts[i])), sizes[s]) and x["target"] == pytest.approx(want[s])
        assert 0 <= x["taken"] <= 3 * x["size"]
        taken[s] += x["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(8, 0.02 * want[s]), (s, taken[s], want[s])
    again = {x["doc_id"]: x for x in mixing.mix_sources(docs.repartition(7)).collect()}
    assert again == got
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert {x["taken"] for x in mixing.mix_sources(docs.filter("source = 'empty'")).collect()} == {0}


def test_mixing_keeps_a_tiny_source_beside_a_large_corpus(spark):
    texts = [prose(i, 100) for i in range(402)]
    sources = ["large"] * 200 + ["other"] * 200 + ["tiny"] * 2
    rows = mixing.mix_sources(frame(spark, texts, sources=sources), shard_words=5000).collect()
    for name in set(sources):
        mine = [x for x in rows if x["source"] == name]
        assert abs(sum(x["taken"] for x in mine) - mine[0]["target"]) <= 4


def dealt(votes, seats):
    have = [0] * len(votes)
    for _ in range(seats):
        have[max(range(len(votes)), key=lambda i: (votes[i] / (2 * have[i] + 1), -i))] += 1
    return have


def test_apportionment_is_sainte_lague(spark):
    """Sequential dealing of random groups, one large party beside many small ones, ties and zero votes; all at once."""
    r = random.Random(8)
    cases = [([r.choice([0, 1, 5, r.randrange(1, 2000)]) for _ in range(r.randrange(1, 30))] + [3], r.randrange(0, 80)) for _ in range(12)]
    cases += [([10_000] + [1000] * 50, 60), ([800.0] + [1.2] * 1000, 2000), ([1000.0] + [0.8] * 1000, 1800), ([300.49] + [1.0036] * 700, 1003), ([5] * 9, 4), ([0, 0, 3], 7), ([0, 0], 3)]
    df = spark.createDataFrame([(g, i, float(v), seats) for g, (votes, seats) in enumerate(cases) for i, v in enumerate(votes)], "g int, p long, v double, s long")
    got = {}
    for x in mixing.apportion(df, ["g"], "p", "v", "s", "out").collect():
        got[x["g"], x["p"]] = x["out"]
    for g, (votes, seats) in enumerate(cases):
        assert [got[g, i] for i in range(len(votes))] == (dealt(votes, seats) if any(votes) else [0] * len(votes)), g


def test_apportionment_of_one_group(spark):
    votes = [10_000.0] + [1000.0] * 50
    df = spark.createDataFrame([(i, v, 60) for i, v in enumerate(votes)], "p long, v double, s long")
    got = {x["p"]: x["out"] for x in mixing.apportion(df, [], "p", "v", "s", "out").collect()}
    assert [got[i] for i in range(len(votes))] == dealt(votes, 60)


def test_numbering_is_global(spark):
    r = random.Random(1)
    rows = [(r.randrange(50), r.choice(["a", "b", None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "x int, s string").repartition(7)
    got = [(r["x"], r["s"]) for r in sorted(mixing.numbered(df, [mixing.F.col("s").asc_nulls_last(), mixing.F.col("x")], "n").collect(), key=lambda r: r["n"])]
    assert got == sorted(rows, key=lambda t: (t[1] is None, t[1] or "", t[0]))


def test_words_equal_pattern():
    texts = ["a b c", None, "", " x\ty\x0bz ", "É é", "end"]
    w = Words(pa.array(texts))
    got = [bytes(w.data[s:e]).decode() for s, e in zip(w.starts, w.ends)]
    assert got == [x for t in texts for x in words(t)] and w.counts().tolist() == [len(words(t)) for t in texts]
    h = w.hashes()
    assert len(set(h.tolist())) == len(set(got))
