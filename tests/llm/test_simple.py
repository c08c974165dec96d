"""Quality rules, decontamination, secret scans, packing, sharding and toxicity against plain Python."""

from __future__ import annotations

import dataclasses
import hashlib
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corvidex.llm import decontaminate, packing, quality_rules, secret_scan, sharding, toxicity

ODD = [None, "", "   \n\t", "x", "a b c", "\n\n", "ä ö " * 3, "word " * 200, "a b c a b c\n" * 30, " x", "\x1cq\x85z", "# * $ %" * 20, "w" * 100_000, "Aa1 !! " * 60]

# --- quality ------------------------------------------------------------------


def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    hit = {i + k for i, g in enumerate(grams) if g in twice for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words)


def test_quality(docs, spark, sf):
    texts = [*ODD, *(r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect())]
    out = quality_rules.apply_policy(quality_rules.ledger(docs(texts, extra=True)))
    rows = {r.doc_id: r for r in out.collect()}
    for k, t in enumerate(texts):
        r = rows[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_quality(t), t
        assert not (r.base_failed and r.kept)
    kept = quality_rules.keep(docs(texts, extra=True))
    assert {r.doc_id for r in kept.collect()} == {k for k, r in rows.items() if r.kept} and "score" in kept.columns


def test_quality_policies(docs):
    book = quality_rules.ledger(docs(["word " * 100, "x", "A B! " * 60 + " ".join(map(str, range(300)))])).cache()
    none = quality_rules.Policy("none", ())
    assert quality_rules.apply_policy(book, none).where("kept").count() == 1  # the base rules always reject
    cut = {r.rule: r for r in quality_rules.ablations(book).collect()}
    assert cut["too_short"].n_failed == 1 and cut["repeated_trigrams"].n_failed == 1 and cut["too_short"].n_docs == 3
    assert quality_rules.ledger(docs([(1, "a"), (1, "a"), (None, "b")])).count() == 3
    assert quality_rules.ledger(docs([])).count() == 0


# --- decontamination --------------------------------------------------------------


def plain_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def plain_contamination(texts, items):
    wins = {}
    for item, t in items:
        w = plain_words(t)
        for i in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[i : i + 13]), set()).add(str(item))
    for t in texts:
        w = plain_words(t)
        hit, found = set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if own := wins.get(tuple(w[i : i + n])):
                    found |= own
                    hit |= set(range(i, i + n))
        yield len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_decontaminate(docs, spark):
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "déjà", "ÉTÉ", "x1", "the", "of"]
    items = [(10, " ".join(rng.choices(vocabulary, k=30))), (2, "Short, item!"), (3, ""), (4, None), (5, "the the the"), (11, " ".join(rng.choices(vocabulary, k=13)))]
    texts = [*ODD, items[0][1].upper().replace("ÉTÉ", "ÉTÉ"), "pre " + items[0][1].replace(" ", " -- ") + " post", "so a short item, here", "shorter item", "the the the the", "x" + items[5][1], " ".join(vocabulary * 40) + items[5][1]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = list(plain_contamination(texts, items))
    for block in (1 << 20, 3000, 40):
        out = decontaminate.digest(decontaminate.scan(docs(texts, extra=True), bench, most_nodes=block))
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out.collect()}
        assert [got[k] for k in range(len(texts))] == want
        kept = {r.doc_id for r in decontaminate.keep(docs(texts), bench, most_nodes=block).collect()}
        assert kept == {k for k, w in enumerate(want) if not w[4]}
    spans = {r.doc_id: r.spans for r in decontaminate.scan(docs(texts), bench).collect()}
    a, b = spans[len(ODD) + 2][0]
    assert texts[len(ODD) + 2][a:b] == "short item"
    assert decontaminate.digest(decontaminate.scan(docs(texts), bench.where("false"))).where("n_hit > 0").count() == 0


def test_decontaminate_blocks(docs, spark, monkeypatch):
    """Long items are cut into pieces that lose no window, automata keep to their bound, and repeated rows come back as often."""
    rng = random.Random(7)
    words = [f"w{k}" for k in range(3000)]
    long, other = " ".join(rng.choices(words, k=700)), " ".join(rng.choices(words, k=40))
    bench = spark.createDataFrame([(1, long), (2, other), (3, long)], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 50)
    blocks = list(decontaminate._blocks(bench, 13, 20_000))
    sizes = [decontaminate.Scanner(b).automaton.get_stats()["nodes_count"] for b in blocks]
    assert len(blocks) > 5 and max(sizes) <= 20_000 + 20_000 / 2
    pieces = [w for b in blocks for _, t in b for w in decontaminate.windows(t)]
    assert set(pieces) == decontaminate.windows(long.encode()) | decontaminate.windows(other.encode())
    cut = long.split()
    texts = [(1, " ".join(cut[40:70])), (1, " ".join(cut[40:70])), (1, "another text"), (None, other), (2, None), (3, " ".join(cut[:13] + ["x"] * 400)), (4, "x " * 20_000 + other)]
    for most in (20_000, 10**7):
        rows = sorted(tuple(r) for r in decontaminate.digest(decontaminate.scan(docs([t for t in texts if t[0]], extra=True), bench, most_nodes=most)).select("doc_id", "n_words", "n_hit", "n_items", "contaminated").collect())
        assert rows == [(1, 2, 0, 0, False), (1, 30, 30, 2, True), (1, 30, 30, 2, True), (2, 0, 0, 0, False), (3, 413, 13, 2, False), (4, 20_040, 40, 1, False)]
        kept = decontaminate.keep(docs(texts, extra=True), bench, most_nodes=most)
        assert sorted((r.doc_id or 0, len(r.text or "")) for r in kept.collect()) == sorted((i or 0, len(t or "")) for i, t in texts if t not in (texts[0][1], other)) and "score" in kept.columns


# --- secrets ---------------------------------------------------------------------------

_BASE = (("assign", r"(?a:(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6), ("access", r"(AKIA[A-Z0-9]+)", 20), ("hex", r"([0-9a-f]+)", 24))


def plain_secrets(t):
    spans = [(m.start(), k, name, m.end()) for k, (name, p, least) in enumerate(_BASE) for m in re.finditer(p, t or "") if len(m[1]) >= least]
    spans.sort()
    return spans


SECRET_TEXTS = [*ODD, "password=abcdef", "Password : 'abcdef12' x", "token=token :abcdef", "API_KEY=\"zzzzzz\" and apikey= short token=ab", "é AKIA" + "A1" * 8 + " " + "0af" * 9, "AKIAAKIA" + "B" * 12, "AKIA" + "B" * 15, "deadbeef" * 3 + "g" + "deadbeef" * 2, "secret=" + "ab12" * 10 + "\nsecret:\nx", "passwd=aKelvin Key tokenſ=abcdefgh", "eyJ" + "a" * 20 + "." + "b" * 20 + ".c x -----BEGIN RSA PRIVATE KEY----- https://u:secretpw@h/", "password=" * 5 + "abcdef"]


def test_secrets(docs, spark):
    texts = [*SECRET_TEXTS, SECRET_TEXTS[-1]]
    rows = {r.doc_id: r for r in secret_scan.digest(secret_scan.find(docs(texts, extra=True))).collect()}
    for k, t in enumerate(texts):
        want = plain_secrets(t)
        r = rows[k]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[2] == n for s in want) for n in ("assign", "access", "hex")), t
        joined = ",".join(f"{n}:{a}:{b}" for a, _, n, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (t, joined, r.spans)
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_ledger_scans_unseen_pairs_only(docs):
    first = secret_scan.update(docs(["a password=abcdef", "b"])).cache()
    assert first.count() == 2
    more = docs(["b", "a password=abcdef", "a password=abcdef", "new token=abcdef"])
    assert secret_scan.update(more, first).count() == 1
    bumped = tuple(dataclasses.replace(r, version=r.version + 1) for r in secret_scan.RULES)
    assert secret_scan.update(more, first, bumped).count() == 3
    found = {r.doc_id: len(r.findings) for r in secret_scan.find(more, first).collect()}
    assert found == {0: 0, 1: 1, 2: 1, 3: 1}
    assert secret_scan.find(docs([])).count() == 0


def test_durable_ledger(docs, spark, tmp_path):
    """Runs meet what earlier ones wrote: only a changed rule is applied to known texts, and its old findings count no more."""
    path, rules = str(tmp_path / "ledger"), secret_scan.RULES
    texts = ["a password=abcdef AKIA" + "Z" * 16, "clean", None, "x" * 50_000 + " token=abcdef"]
    assert secret_scan.append(docs(texts), path).count() == 4 and secret_scan.append(docs(texts), path).count() == 4
    plain = {r.doc_id: r.findings for r in secret_scan.find(docs(texts)).collect()}
    assert {r.doc_id: r.findings for r in secret_scan.find(docs(texts), secret_scan.read_ledger(spark, path)).collect()} == plain
    # The access rule now asks for more, and a rule is new; the others keep their versions.
    changed = tuple(dataclasses.replace(r, least=30, version=2) if r.kind == "access" else r for r in rules) + (secret_scan.SecretRule("clean", "(clean)", 1, 1, "true", False),)
    fresh = secret_scan.update(docs([*texts, "new AKIA" + "Q" * 30]), secret_scan.read_ledger(spark, path), changed).collect()
    assert sorted(len(r.scanned) for r in fresh) == [2, 2, 2, 2, len(changed)] and {tuple(sorted(r.scanned)) for r in fresh if len(r.scanned) == 2} == {("access:2", "clean:1")}
    book = secret_scan.append(docs([*texts, "new AKIA" + "Q" * 30]), path, changed)
    assert book.count() == 9
    got = {r.doc_id: [(f.kind, f.start, f.end) for f in r.findings] for r in secret_scan.find(docs([*texts, "new AKIA" + "Q" * 30]), book, changed).collect()}
    assert got == {0: [("assign", 2, 17)], 1: [("clean", 0, 5)], 2: [], 3: [("assign", 50_001, 50_013)], 4: [("access", 4, 38)]}
    # With the former rules the ledger has all that they found.
    assert {r.doc_id: r.findings for r in secret_scan.find(docs(texts), book).collect()} == plain
    assert {r.doc_id: r.text for r in secret_scan.redact(docs(texts), book).collect()} == {r.doc_id: r.text for r in secret_scan.redact(docs(texts)).collect()}


def test_redact(docs):
    texts = ["x password=" + "0123456789abcdef" * 2 + " y", "clean", None, "token=abcdef", "a AKIA" + "Z" * 16 + " b secret=qwerty1"]
    rows = {r.doc_id: r for r in secret_scan.redact(docs(texts)).collect()}
    assert [rows[k].text for k in range(5)] == ["x [SECRET] y", "clean", None, "[SECRET]", "a [SECRET] b [SECRET]"]
    assert rows[0].n_chars == len("x [SECRET] y") and rows[1].n_chars == 5


# --- packing -----------------------------------------------------------------------------


def test_best_fit_takes_the_tightest_compatible_bin():
    bins, at = packing.best_fit([6, 7, 3, 2, 3], [0, 1, 2, 2, 1], [-1] * 5, 10)
    assert bins == [0, 1, 1, 0, 2] and at == [0, 0, 7, 6, 0]
    bins, _ = packing.best_fit([2, 2, 2], [0, 1, 2], [5, 5, -1], 10)
    assert bins == [0, 1, 0]


def test_packing(docs):
    rng = random.Random(1)
    texts = [" ".join(["w"] * rng.choice([0, 1, 5, 30, 100, 250, 400])) + f" {k % 20}" for k in range(300)] + [None, "", "v " * 200]
    frame = docs(texts, extra=True).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 7)))
    source = {r.doc_id: r.source for r in frame.collect()}
    rows = packing.pack(packing.measure(frame), 100, 2000).collect()
    spans, bins = {}, {}
    for r in rows:
        spans.setdefault(r.doc_id, []).append((r.doc_start, r.n_tokens))
        if r.bin_id:
            bins.setdefault(r.bin_id, []).append(r)
    assert set(spans) == set(range(len(texts)))
    for k, t in enumerate(texts):
        at = 0
        for a, n in sorted(spans[k]):
            assert a == at
            at += n
        assert at == len((t or "").split())
    for held in bins.values():
        held.sort(key=lambda r: r.bin_start)
        assert sum(r.n_tokens for r in held) == held[0].bin_tokens <= 100
        assert [r.bin_start for r in held] == [sum(x.n_tokens for x in held[:k]) for k in range(len(held))]
        assert len({source[r.doc_id] for r in held}) == len(held) and len({texts[r.doc_id] for r in held}) == len(held)
    assert packing.pack(packing.measure(docs([]))).count() == 0


# --- sharding ------------------------------------------------------------------------------


def test_sharding(docs, spark, tmp_path):
    frame = docs([*ODD, *(f"text {k}" for k in range(100)), "text 1"], extra=True)
    store, manifest = sharding.round_trip(frame, arrivals=9)
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(store.read().select(*frame.columns)) == key(frame)
    assert len(manifest.runs) < 9 and any(r.merged_from for r in manifest.runs)
    assert sharding.round_trip(docs([]))[1].version == 0


def test_sharding_versions(docs, tmp_path, spark):
    store = sharding.Store(spark, f"file://{tmp_path}/store", fan_out=3)
    one = store.append(docs(["a", "b"]))
    two = store.append(docs(["c"]))
    assert (one.version, two.version) == (1, 2) and store.read(1).count() == 2 and store.read().count() == 3
    with pytest.raises(sharding.Conflict):
        store.commit(one, one.schema, ())
    with pytest.raises(ValueError):
        store.append(docs(["x"]).drop("lang"))
    store.append(docs(["d"]))
    assert store.due(store.manifest()) and len(store.compact().runs) == 1 and store.read().count() == 4
    assert store.read(2).count() == 3  # until the vacuum
    assert store.vacuum() == 3 and store.read().count() == 4


def test_vacuum_of_crashed_writers(docs, tmp_path, spark):
    """A run that was never committed goes when it is old enough; a batch loses its unlisted runs only."""
    store = sharding.Store(spark, f"file://{tmp_path}/store", fan_out=2)
    assert store.vacuum() == 0
    store.append(docs(["a", "b"]))
    crashed = store._write(docs(["never committed"]))
    store.append_split(docs(["c", "d"]).selectExpr("*", "doc_id AS arrival"), "arrival")
    batch = next(r.name.split("/")[0] for r in store.manifest().runs if "/" in r.name)
    (tmp_path / "store/data" / batch / "arrival=9").mkdir()
    (tmp_path / "store/data/run-died").mkdir()
    (tmp_path / "store/data/run-died/_temporary").mkdir()
    assert store.vacuum() == 0 and (tmp_path / "store/data" / crashed.name).exists()  # it may be at work
    time.sleep(0.1)
    assert store.vacuum(orphan_hours=0) == 3 and store.vacuum(orphan_hours=0) == 0
    left = {p.name for p in (tmp_path / "store/data").iterdir()}
    assert crashed.name not in left and "run-died" not in left
    assert sorted(r.text for r in store.read().collect()) == ["a", "b", "c", "d"]
    store.compact()
    assert store.vacuum() > 0 and store.vacuum() == 0 and store.read().count() == 4


def plain_best_fit(sizes, sources, clusters, capacity):
    """Every bin is looked at for each item."""
    bins, out = [], []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        fit = [(b["left"], k) for k, b in enumerate(bins) if b["left"] >= size and not (s >= 0 and s in b["s"]) and not (c >= 0 and c in b["c"])]
        k = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append({"left": capacity, "s": set(), "c": set()})
        out.append((k, capacity - bins[k]["left"]))
        bins[k]["left"] -= size
        bins[k]["s"].add(s)
        bins[k]["c"].add(c)
    return [k for k, _ in out], [at for _, at in out]


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_against_every_bin(seed):
    r = random.Random(seed)
    sizes = sorted((r.randint(1, 60) for _ in range(400)), reverse=True)
    sources, clusters = [r.choice((-1, 0, 0, *range(30))) for _ in sizes], [r.choice((-1, -1, *range(9))) for _ in sizes]
    assert packing.best_fit(sizes, sources, clusters, 100) == plain_best_fit(sizes, sources, clusters, 100)


def test_packing_of_odd_rows(docs):
    """Repeated rows, no texts, a text of many bins and columns of clashing names: every piece is somewhere once."""
    rows = [(1, "a b c"), (1, "a b c"), (1, "other words"), (None, "x y"), (2, None), (3, ""), (4, "w " * 25_003)]
    found = packing.pack(packing.measure(docs(rows, extra=True))).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in found if r.doc_id != 4) == [(0, 2), (1, 2), (1, 3), (1, 3), (2, 0), (3, 0)]
    long = sorted((r.doc_start, r.n_tokens) for r in found if r.doc_id == 4)
    assert sum(n for _, n in long) == 25_003 and [a for a, _ in long] == [k * packing.CAPACITY for k in range(len(long))]
    copies = [r.bin_id for r in found if (r.doc_id, r.n_tokens) == (1, 3)]
    assert len(set(copies)) == 2 and packing.pack(packing.measure(docs([]))).count() == 0


# --- toxicity ---------------------------------------------------------------------------------


def test_grammar():
    reader = toxicity.Reader({"idiot": 4.0, "scum*": 4.0})
    only = lambda t: reader.emissions(t)
    assert only("You are an IDIOT. fine") == [{"insult": 4.0, "aimed": 4.0}]
    assert only("he is not an idiot") == [{"insult": 4.0, "negated": 4.0, "aimed": 4.0}]
    assert only("She said idiot")[0]["reported"] == 4.0
    assert only("scumbag!") == [{"insult": 4.0}]
    assert only("idiots") == [] and only("") == []
    assert only("I will kill them")[0]["threat"] == 1.0
    assert only("not here at all in this place idiot")[0].get("negated") is None


def test_toxicity(docs, spark):
    rng = random.Random(5)
    words = [f"wort{k}" for k in range(300)]
    texts, toxic = [], []
    for k in range(600):
        w = rng.choices(words, k=40)
        bad = k % 4 == 0
        if bad:
            for _ in range(2):
                w.insert(rng.randrange(40), rng.choice(["schuft", "lumpen" + rng.choice(words), "gauner"]))
        texts.append(" ".join(w) + ".")
        toxic.append(int(bad))
    texts += [None, ""]
    frame = docs(texts, extra=True)
    labels = spark.createDataFrame([*enumerate(toxic), (None, 1), (5, None), (99_999, 1)], "doc_id long, toxic int")
    model = toxicity.learn(frame, labels)
    assert "schuft" in model.lexicon and any(t.startswith("lump") for t in model.lexicon)
    rows = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    assert len(rows) == len(texts)
    held = [k for k in range(600) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(rows[k].held_out == (k in set(held)) for k in range(600))
    assert sum(rows[k].predicted == toxic[k] for k in held) >= 0.95 * len(held)
    assert rows[600].score == rows[601].score < 0.5
    nothing = toxicity.learn(frame, labels.where("false"))
    assert toxicity.score(frame, nothing).where("score BETWEEN 0 AND 1").count() == len(texts)


def test_private_keys(docs):
    """A key goes whole, however many hyphens it has; without an end line its base64 lines go; both engines find the same."""
    import duckdb

    key = lambda body: f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----"
    base64 = "\n".join("QUJD" * 16 for _ in range(3))
    bodies = [base64, "a-b--c---d----e " * 20_000, "x-" * 1000 + "x", "Proc-Type: 4\n\n" + base64, "a-----b", "a-", "-----BEGIN PRIVATE KEY-----\nz"]
    texts = [f"before {key(b)} after" for b in bodies] + [f"-----BEGIN PRIVATE KEY-----\n{base64}\nQUI= tail", "-----BEGIN PRIVATE KEY----- tail", key("a") + key("b-c")]
    rows = {r.doc_id: [(s.start, s.end) for s in r.findings if s.kind == "private_key"] for r in secret_scan.find(docs(texts)).collect()}
    for k in range(4):
        assert rows[k] == [(7, len(texts[k]) - 6)]
    assert all(rows.values()) and len(rows[len(texts) - 1]) == 2
    rule = next(r for r in secret_scan.RULES if r.kind == "private_key")
    for k, text in enumerate(texts):
        found = duckdb.execute("SELECT regexp_extract_all(?, ?, 0)", [text, rule.sql]).fetchone()[0]
        assert found == [text[a:z] for a, z in rows[k]], k


def test_toxicity_labels_of_one_class(docs, spark):
    """Labels of one class call nothing toxic, and evidence alone bounds the lexicon."""
    label = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int, score string")
    some = docs([(1, "you stupid fool"), (2, ""), (3, None), (4, "a fine day"), (4, "a fine day")])
    for labels in ([(1, 1, "x")], [(1, 1, "x"), (2, 1, "x"), (4, 1, "x")], [(1, 0, "x"), (4, 0, "x")], [(None, 1, "x"), (1, None, "x")]):
        found = toxicity.score(some, toxicity.learn(some, label(labels))).collect()
        assert len(found) == 5 and all(r.predicted == 0 and 0 < r.score < 0.5 for r in found)
    assert len(toxicity.weigh(((f"w{k}", 10, 0) for k in range(5000)), 100, 100)) == 5000
    same = [("aaaa", 10, 0), ("bbbb", 10, 0), ("cccc", 2, 0), ("dddd", 10, 9)]
    assert toxicity.weigh(same, 100, 100) == toxicity.weigh(same[::-1], 100, 100) and set(toxicity.weigh(same, 100, 100)) == {"aaaa", "bbbb"}
