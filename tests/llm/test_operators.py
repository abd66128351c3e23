"""Each operator against a brute-force version on small, awkward documents."""

import hashlib
import random
import re
from collections import Counter

import pytest

from sommelix.llm import (
    common,
    decontaminate,
    host_rules,
    jaccard_join,
    language_id,
    line_dedup,
    mixing,
    quality_crf,
    secret_scan,
    substring_dedup,
    token_count,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, score double, class string"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text) -> list[str]:
    return BLANK.findall(text or "")


def corpus() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages, repeats, nulls, empty, blank and odd texts, repeated rows and null ids."""
    rnd = random.Random(7)
    vocabulary = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "la", "mu", "9"]
    vocabulary += [f"w{i}" for i in range(150)]

    def prose(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    passage = prose(60)
    base = [prose(rnd.randint(1, 400)) for _ in range(25)]
    texts: list[str | None] = [None, "", "  \n\t ", "one", "one two three", "!!! ???", "x" * 5000, "la " * 300, "a b c d " * 40]
    texts += base
    texts += [base[k] for k in (1, 1, 2, 3)]
    for k in range(12):  # near copies
        w = base[k].split()
        for _ in range(1 + len(w) // 60):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        texts.append(" ".join(w))
    texts += [f"{prose(30)} {passage} {prose(30)}" for _ in range(12)]
    texts += ["\n".join([prose(9), passage, "", prose(12), "same line", "same  line"]) for _ in range(3)]
    line = prose(12).split()
    for k in (0, 3, 11):
        other = [*line]
        other[k] = "changed"
        texts.append("first words\n" + " ".join(line) + "\n" + " ".join(other) + "\n" + " ".join(other[:-1]))
        texts.append(" ".join(other[: k + 1] + ["more"] + other[k + 1 :]))
    rows: list[tuple[int | None, str | None]] = [(3 * i + 1, t) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, base[4]), (None, None), (5, base[20] + " end"), (1 << 60, prose(50))]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    rnd = random.Random(3)
    sources = ["a", "b", None, "ä"]
    return spark.createDataFrame(
        [(i, t, None, rnd.choice(sources), None, "row", 1.5, "c") for i, t in rows], SCHEMA
    ).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# secrets


def brute_secrets(text):
    out = []
    for k, rule in enumerate(secret_scan.RULES):
        pattern = {"hex": "[0-9a-f]+"}.get(rule.kind, rule.pattern)
        for m in re.finditer(pattern, text, re.ASCII | re.IGNORECASE * rule.ignore_case):
            if len(m[rule.group]) >= rule.at_least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def scanner():
    return secret_scan.Scanner(secret_scan.build())


def test_secret_spans_equal_leftmost_regex_matches(scanner):
    rnd = random.Random(1)
    parts = ["password", "token", "=", ":", " ", '"', "'", "api_key", "apikey", "AKIA", "ABCDEF1234567890", "deadbeef"]
    parts += ["0123456789abcdef", "é", "secret", "\n", "eyJ", ".", "ghp_", "-----BEGIN RSA", "-----", "SeCret", "KEY", "ſ", "K"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 25)))
        assert scanner(text) == brute_secrets(text), text


def test_secret_edges(scanner):
    assert scanner(None) == scanner("") == []
    assert [s[::2] for s in scanner("é token=abcdef")] == [(2, 14)]
    assert scanner("token=abcde") == []
    assert scanner("f" * 100_000) == [(0, 2, 100_000)]


def test_ambiguous_rules_are_refused():
    with pytest.raises(ValueError):
        secret_scan.build((secret_scan.Rule("x", "ab(cd)*"),))


def test_secret_query_columns(docs, empty):
    out = secret_scan.scan_secrets(docs)
    assert out.count() == docs.count()
    assert secret_scan.scan_secrets(empty).count() == 0


# tokens


def test_token_histogram_against_encoding(docs, rows, empty):
    import base64

    import tiktoken

    with open(token_count.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=token_count.PATTERN, mergeable_ranks=ranks, special_tokens={})
    n = [len(encoding.encode_ordinary(t or "")) for _, t in rows]
    limits = token_count.at_every_limit(token_count.length_histogram(token_count.token_lengths(docs)), block=16)
    got = {r["n_tokens"]: r for r in limits.collect()}
    assert {k: r["n_docs"] for k, r in got.items()} == Counter(n)
    for k, r in got.items():
        assert r["docs_at_least"] == sum(x >= k for x in n)
        assert r["tokens_at_least"] == sum(x for x in n if x >= k)
        assert r["truncated_tokens"] == sum(min(x, k) for x in n)
        assert r["quantile"] == pytest.approx(sum(x <= k for x in n) / len(n))
        assert r["total_tokens"] == sum(n)
    at = {r["context"]: r["truncated_tokens"] for r in token_count.truncated_at(limits, [0, 7, 33, 10**6]).collect()}
    assert at == {c: sum(min(x, c) for x in n) for c in (0, 7, 33, 10**6)}
    half = token_count.quantiles(limits, [0.5]).first()["n_tokens"]
    assert half == sorted(n)[-(-len(n) // 2) - 1]
    assert token_count.at_every_limit(token_count.length_histogram(token_count.token_lengths(empty))).count() == 0


def test_token_counts_of_very_long_runs():
    import base64

    import tiktoken

    with open(token_count.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding, count = tiktoken.Encoding("own", pat_str=token_count.PATTERN, mergeable_ranks=ranks, special_tokens={}), token_count.counter(ranks)
    for blank in (" ", "\n", " \n", "\u3000", "\t\r\n ", "\x85"):
        for n in (1, 999, 1000, 1001, 4000):
            for before, after in (("", ""), ("word", ""), ("", "word"), ("a's", "'s"), ("x ", "!?"), ("\x1c", "\x1f9")):
                text = before + blank * n + after + " and more" + blank * 1500 + after
                assert count(text) == len(encoding.encode_ordinary(text)), (blank, n, before, after)
    assert count(" " * 2_000_000) == len(encoding._encode_single_piece(" " * 2_000_000))
    assert count(" " * 2_000_000 + "x") == len(encoding._encode_single_piece(" " * 1_999_999)) + len(encoding.encode_ordinary(" x"))
    assert min(count("a" * 2_000_000), count("7" * 2_000_000), count("word\n" * 400_000)) > 0
    assert count(None) == count("") == 0


# benchmark


def brute_decontamination(rows, items):
    def form(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    windows = []
    for item, text in items:
        w = form(text)
        k = min(13, len(w))
        windows += [(item, w[i : i + k]) for i in range(len(w) - k + 1) if w]
    out = []
    for doc, text in rows:
        w, hit, ids = form(text), set(), set()
        for item, p in windows:
            for i in range(len(w) - len(p) + 1):
                if w[i : i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    ids.add(item)
        ids.discard(None)
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(sorted(map(str, ids)))), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part_chars", [decontaminate.PART_CHARS, 300])
def test_decontamination(spark, docs, rows, empty, part_chars, monkeypatch):
    long = [t for _, t in rows if t and len(t.split()) > 40]
    items = [(1, long[0]), (2, " ".join(long[1].split()[5:25]).upper()), (3, "One"), (10, "two three"), (4, None), (5, "?!"), (None, long[2]), (2, long[3])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontaminate.find_benchmark, "__defaults__", (13, part_chars, None))
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    out = decontaminate.decontamination(docs, benchmark)
    assert found(out.select("row.doc_id", *columns), "doc_id", *columns) == brute_decontamination(rows, items)
    none = decontaminate.decontamination(docs, benchmark.limit(0))
    assert none.where("contaminated OR n_hit > 0").count() == 0
    assert decontaminate.decontamination(empty, benchmark).count() == 0


# substrings


def brute_substrings(rows, window=35):
    seen = Counter(tuple(w[i : i + window]) for _, t in rows for w in [words(t)] for i in range(len(w) - window + 1))
    out = []
    for doc, text in rows:
        w = words(text)
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((doc, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("shard", "hot"), [(substring_dedup.SHARD_WORDS, substring_dedup.HOT), (200, 3)])
def test_substring_dedup(docs, rows, empty, shard, hot):
    out = substring_dedup.dedup_substrings(docs, shard_words=shard, hot=hot)
    assert found(out, "doc_id", "n_words", "n_removed", "kept") == brute_substrings(rows)
    assert substring_dedup.dedup_substrings(empty).count() == 0


def test_fm_index_counts():
    rnd = random.Random(2)
    texts = [b" ".join(rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randint(4, 60))) for _ in range(30)]
    seen = Counter(tuple(w[i : i + 4]) for t in texts for w in [t.split()] for i in range(len(w) - 3))
    wanted = [[i for i in range(len(w) - 3) if seen[tuple(w[i : i + 4])] > 1] for t in texts for w in [t.split()]]
    runs = [substring_dedup._runs(found, 4) for found in substring_dedup.search_shard(texts, 4)]
    assert [[i for a, n in r for i in range(a, a + n)] for r in runs] == wanted


# mixing


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, capped = 1.5 * sum(sizes.values()), {}, set()
    while True:
        rest = [s for s in names if s not in capped]
        room = left - sum(2 * sizes[s] for s in capped)
        target = {s: 2.0 * sizes[s] for s in capped} | {s: room * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mixing(docs, rows, empty):
    out = mixing.mix(docs, block_words=8, shard_words=300, group_shards=2).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    taken = Counter()
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert sorted(r["size"] for r in out) == sorted(len(words(t)) for _, t in rows)
    target = brute_targets(sizes)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.05 * target[s] + 16
    again = mixing.mix(docs.repartition(2), block_words=8, shard_words=300, group_shards=2).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))
    assert mixing.mix(empty).count() == 0


def test_null_and_repeated_ids_spread_over_shards(spark):
    """Many rows with one id do not gather: equal marks would take all of a shard's or none of its words."""
    data = [(None, f"w{i} " * 40, "a") for i in range(300)] + [(7, "same text " * 20, "b")] * 300
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    out = mixing.mix(df, block_words=8, shard_words=400).collect()
    assert len(out) == 600 and sum(r["doc_id"] is None for r in out) == 300
    for source in "ab":
        taken = [r["taken"] for r in out if r["source"] == source]
        target = next(r["target"] for r in out if r["source"] == source)
        assert abs(sum(taken) - target) <= 0.05 * target + 16
    again = mixing.mix(df.repartition(7), block_words=8, shard_words=400).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))


def test_apportionment_gives_highest_quotients(spark):
    rnd = random.Random(5)
    for n, seats in ((1, 7), (5, 3), (6, 100), (4, 0)):
        votes = {k: rnd.randint(0, 1000) for k in range(n)}
        df = spark.createDataFrame([("p", k, v, seats) for k, v in votes.items()], "p string, k int, v bigint, seats bigint")
        got = {r["k"]: r["q"] for r in mixing.apportion(df, ["p"], ["k"], "v", "seats", "q").collect()}
        quotients = sorted(((-v / (2 * i - 1), k) for k, v in votes.items() for i in range(1, seats + 1)))[:seats]
        assert got == {k: sum(x == k for _, x in quotients) for k in votes}


# languages and quality


def test_language_of_held_out_texts(spark, empty):
    rnd = random.Random(4)
    tongues = {"xx": ["tha", "ing", "ous"], "yy": ["ich", "ung", "sch"], "zz": ["ção", "não", "inho"]}
    data = [(i, " ".join("".join(rnd.choices(tongues[t], k=3)) for _ in range(30)), t) for i in range(240) for t in [rnd.choice(list(tongues))]]
    data += [(500, None, "xx"), (501, "12 !?", "yy"), (502, "", None), (None, "thaing", None)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    model = language_id.train(df)
    got = {r["row"]["doc_id"]: r for r in language_id.identify(df, model).collect()}
    assert all(got[i]["lang_pred"] == t and 0 <= got[i]["score"] <= 1 for i, _, t in data[:240])
    assert all(got[i]["lang_pred"] == "und" for i in (500, 501, 502))
    assert {r["lang_pred"] for r in language_id.identify(df, None).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0
    swapped = df.selectExpr("doc_id", "text", "if(doc_id % 2 = 0, 'xx', lang) AS lang").where(~common.learnable(df["doc_id"]))
    assert language_id.train(swapped) is None  # held-out labels are not learned from


def test_presence_of_long_text_in_pieces(monkeypatch):
    text = "the quick brown fox " * 200
    whole, _ = language_id.presence([text, "ab"])
    monkeypatch.setattr(language_id, "PIECE_CHARS", 37)
    pieces, _ = language_id.presence([text, "ab"])
    assert (whole == pieces).all()


def test_crf_marginals_equal_enumeration():
    import itertools

    import numpy as np

    rnd = np.random.default_rng(1)
    crf = quality_crf.Crf()
    crf.w, crf.pairs = rnd.normal(size=len(crf.w)), rnd.normal(size=(2, 2))
    sizes = [1, 2, 4]
    docs = [rnd.normal(size=(n, len(crf.w))) for n in sizes]
    good, _ = crf.marginals(*quality_crf._padded(docs))
    for row, x in enumerate(docs):
        total, on = 0.0, np.zeros(len(x))
        for labels in itertools.product((0, 1), repeat=len(x)):
            s = sum(x[i] @ crf.w for i, y in enumerate(labels) if y) + sum(crf.pairs[a, b] for a, b in zip(labels, labels[1:]))
            total += np.exp(s)
            on += np.exp(s) * np.array(labels)
        assert np.allclose(good[row, : len(x)], on / total)


def test_quality_of_held_out_documents(spark, docs, empty):
    rnd = random.Random(6)
    data, marks = [], []
    for i in range(300):
        ok = rnd.random() < 0.6
        lines = [" ".join(rnd.choices(["some", "plain", "words", "here", "today"], k=12)) + "." for _ in range(4)]
        data.append((i, "\n".join(lines if ok else [x.upper().replace(" ", "!! ") for x in lines])))
        marks.append((i, int(ok)))
    df = spark.createDataFrame([*data, (900, None), (901, "")], "doc_id bigint, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (3, None)], "doc_id bigint, quality int")
    model = quality_crf.train(df, labels)
    got = {r["doc_id"]: r["score"] for r in quality_crf.score_quality(df, model).collect()}
    assert all((got[i] >= 0.7) == bool(q) for i, q in marks)
    assert got[900] == got[901] and 0 <= got[900] <= 1
    assert quality_crf.score_quality(docs, quality_crf.Crf()).where("abs(score - 0.5) > 1e-9").count() == 0
    assert quality_crf.score_quality(empty, model).count() == 0
    assert (quality_crf.train(empty, labels).w == 0).all()


# lines


def near(a, b):
    if a == b:
        return True
    if min(len(a), len(b)) < line_dedup.NEAR_WORDS or abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[p + (len(a) >= len(b)) :] == b[p + (len(b) >= len(a)) :]


def test_line_dedup(docs, rows, empty):
    ids = {(i, t): h for i, t, h in docs.select("doc_id", "text", common.doc_key()["hash"].alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, ids[r] or 0))
    earlier, wanted = [], []
    for doc, text in order:
        kept, n, gone = [], 0, 0
        for line in text.split("\n") if text is not None else []:
            w = words(line)
            n += bool(w)
            if w and any(near(w, v) for v in earlier):
                gone += 1
            else:
                kept.append(line)
            if w:
                earlier.append(w)
        wanted.append((doc, n, gone, "\n".join(kept) if text is not None else None))
    out = line_dedup.dedup_lines(docs)
    assert found(out.select("row.doc_id", "n_lines", "n_removed", "row.text"), "doc_id", "n_lines", "n_removed", "text") == sorted(wanted, key=repr)
    assert out.select("row.*").schema.names == docs.schema.names
    assert line_dedup.dedup_lines(empty).count() == 0


# groups


def brute_groups(rows):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t in rows:
        w = words((t or "").translate(low))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = [x for x in (least.get(root(i)), doc) if x is not None]
        least[root(i)] = min(known) if known else None
    return sorted(((doc, len(s), least[root(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=repr)


def many_sizes():
    rnd = random.Random(11)
    rows = []
    for size in (1, 2, 4, 5, 6, 8, 12, 20, 33, 40, 64, 90, 127, 130, 200, 300, 600):
        base = [f"t{size}x{rnd.randrange(10**6)}" for _ in range(size + 4)]
        for edits in range(0, max(2, size // 10)):
            w = [*base]
            for _ in range(edits):
                w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
            cut = rnd.randrange(0, 1 + len(w) // 6)
            rows.append((len(rows) * 7 % 1009, " ".join(w[cut:])))
    return rows


@pytest.mark.parametrize(("spread", "block"), [(1.0, jaccard_join.BLOCK), (0.3, 3)])
def test_jaccard_groups(spark, docs, rows, empty, spread, block):
    """With few segments, what the pigeonhole cannot cover must still be found, in blocks of three."""
    columns = ("doc_id", "n_shingles", "component_id")
    out = jaccard_join.with_component_ids(jaccard_join.jaccard_groups(docs, spread=spread, block=block))
    assert found(out, *columns) == brute_groups(rows)
    more = many_sizes()
    df = spark.createDataFrame(more, "doc_id bigint, text string").repartition(3)
    out = jaccard_join.with_component_ids(jaccard_join.jaccard_groups(df, spread=spread, block=block))
    assert found(out, *columns) == brute_groups(more)
    assert jaccard_join.jaccard_groups(empty, spread=spread).count() == 0


def test_jaccard_partners_in_neighbouring_bands(spark):
    rnd = random.Random(9)
    rows = []
    for size in (5, 7, 9, 13, 15, 18, 27, 31, 36, 40, 58, 63, 70, 120, 127, 140, 250, 300):
        base = [f"p{rnd.randrange(10**9)}" for _ in range(size + 4)]
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(base[size // 5 :])), (len(rows) + 2, " ".join(base + base[: size // 6]))]
    hub = [f"h{k}" for k in range(44)]  # copies link with their original, but not with each other
    for k in range(40):
        w = [*hub]
        w[5 + k % 35] = f"x{k}"
        rows.append((1000 - k, " ".join(w)))
    rows.append((5000, " ".join(hub)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = jaccard_join.with_component_ids(jaccard_join.jaccard_groups(df))
    assert found(got, "doc_id", "n_shingles", "component_id") == brute_groups(rows)


def shares_a_key(x, y, seen):
    """Whether the larger of two sets finds the smaller one; seen are the elements of at least two sets."""
    import numpy as np

    big, small = ((len(s), int((~np.isin(s, seen)).sum()), s[np.isin(s, seen)]) for s in ((x, y) if len(x) >= len(y) else (y, x)))
    kept = jaccard_join.Parts(small[2], jaccard_join.band_of(small[0])).keys
    if jaccard_join.band_of(small[0]) == jaccard_join.band_of(big[0]):
        parts, left = jaccard_join.Parts(big[2], jaccard_join.band_of(big[0])), jaccard_join.may_differ(big[0], big[0]) - big[1]
        picks = parts.pick(np.ones(len(parts.sizes), bool), left + 1)
    else:
        parts, picks, left = jaccard_join.below(*big, 1.0)
    asked = parts.keys[parts.only(picks)]  # odd keys are deletions and meet even ones only
    meets = np.isin(asked[asked % 2 == 0], kept & ~np.uint64(1)).any() or np.isin(asked[asked % 2 == 1] - np.uint64(1), kept).any()
    return parts.worth[picks].sum() <= left or meets


def test_pigeonhole_never_misses():
    import numpy as np

    rnd = np.random.default_rng(3)
    new = lambda n: jaccard_join.mix(rnd.integers(0, 1 << 62, n).astype(np.uint64))
    # all pairs of sizes from 1 to 40, at the least overlap that links and one above
    for r in range(1, 41):
        for s in range(1, r + 1):
            least = -(-3 * (r + s) // 7)  # 100 i >= 75 (r + s - i)
            for both in {least, least + 1} & set(range(1, s + 1)) - ({r} if r == s else set()):
                core = new(both)
                x, y = (np.unique(np.concatenate([core, new(n - both)])) for n in (r, s))
                for seen in (np.unique(np.concatenate([x, y])), core):
                    assert shares_a_key(x, y, seen), (r, s, both)
    for size in [*range(41, 140), 200, 255, 256, 300, 511, 700, 1500]:
        for _ in range(6):
            x = np.unique(new(size))
            drop, add = sorted(rnd.integers(0, size // 7 + 1, 2))
            y = np.unique(np.concatenate([x[rnd.permutation(len(x))[drop:]], new(add)]))
            both = len(np.intersect1d(x, y))
            if 100 * both >= 75 * (len(x) + len(y) - both):
                assert shares_a_key(x, y, np.unique(np.concatenate([x, y])))
                assert shares_a_key(x, y, np.intersect1d(x, y))


def test_odd_sketches_differ_in_no_more_bits_than_the_sets_in_elements():
    import numpy as np

    rnd = np.random.default_rng(4)
    for n in (1, 5, 40, 300, 3000):
        for _ in range(50):
            x, y = (np.unique(jaccard_join.mix(rnd.integers(0, 2 * n, n).astype(np.uint64))) for _ in "xy")
            odd = int(np.bitwise_count((jaccard_join.odd_sketch(x) ^ jaccard_join.odd_sketch(y)).view(np.uint64)).sum())
            assert odd <= len(np.setxor1d(x, y)) and (len(np.setxor1d(x, y)) - odd) % 2 == 0


def test_very_long_lines(spark):
    """One changed word in lines of 60,000 words is found; work grows with the words."""
    w = [f"w{k % 977}" for k in range(60_000)]
    other = [*w]
    other[45_678] = "changed"
    data = [(1, " ".join(w)), (2, " ".join(other)), (3, " ".join(w[:-1])), (4, " ".join(w[:20_000])), (5, "\n" * 100_000 + "end")]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    out = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_dedup.dedup_lines(df).select("row.doc_id", "n_lines", "n_removed").collect()}
    assert out == {1: (1, 0), 2: (1, 1), 3: (1, 1), 4: (1, 0), 5: (1, 0)}


# hosts


def test_host_rules(docs, rows, empty):
    def measures(text):
        text = text or ""
        w = words(text)
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        n = Counter(grams)
        repeated = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 3)}
        lines = [x for x in text.split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
        symbols = sum(text.count(c) for c in host_rules.SYMBOLS)
        return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated), failed

    out = host_rules.host_rules(docs)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert found(out, *columns) == sorted(((d, *measures(t)) for d, t in rows), key=repr)
    assert out.where("kept AND base_failed").count() == 0
    assert host_rules.host_rules(empty).count() == 0


def test_bad_hosts_take_their_documents_along(spark):
    good, bad = " ".join(f"w{i}" for i in range(80)), "short"
    data = [(i, good if i % 10 else bad, "fine") for i in range(100)] + [(200 + i, bad if i else good, "junk") for i in range(40)]
    out = host_rules.host_rules(spark.createDataFrame([*data, (999, good, "new")], "doc_id bigint, text string, source string"))
    kept = {r["doc_id"] for r in out.where("kept").collect()}
    assert kept == {i for i in range(100) if i % 10} | {999}
