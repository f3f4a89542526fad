"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 12 or more characters that keys are made of, with a
digit in it, anywhere in the whole text; what stands after a name with a key
word in it (of English, French, German or Spanish) and a sign (= or :),
whatever its length and characters; what begins as keys of known issuers do;
the password of an address; or a private key from its first mark to its last.
Its features are its length, how its characters follow one another, how much of
it dictionary words cover, whether it is part of a path or address, how it
begins, and the words beside it. The dictionary is the whole words of a public
tokenizer's vocabulary, whose path is a parameter.

The forest is trained from labelled findings: `sampled` takes at most
MOST_FINDINGS of a table of them, by the order of their hashes, with the few
characters around each that features look at. Without any given it learns from
findings written by `made_findings`, whose seed is fixed.

Nulls: a null text has no candidates. Rows that repeat a document, or have no
doc_id, are scanned each for itself. A document without candidates has no row;
columns other than doc_id and text are not looked at. The forest is as large as
TREES and TREE_DEPTH allow, so it is broadcast; its seed is fixed, so equal
findings give equal forests.
"""

from __future__ import annotations

import json
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.quality import STOP_WORDS
from tidemark.llm.runtime import small_batches, table

MOST_FINDINGS, TREES, TREE_DEPTH, LEAST_LEAF = 20_000, 40, 11, 3
#: Characters before and behind a finding that its features look at.
AROUND = 64
#: Characters before a sign in which its name ends.
NAME_CHARS = 64
_RUN = re.compile(r"[A-Za-z0-9+/_=.@:-]{12,}")
_KEY = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
# Words that stand before keys, and words that stand before things that only look like them.
KEY_WORDS = "access api apikey auth authorization bearer credential key passphrase passwd password private pwd secret token".split()
OTHER_WORDS = "checksum commit digest etag file hash id image md5 order page path phone ref revision sha sha1 sha256 uuid version".split()
# The same of French, German and Spanish.
KEY_WORDS_ABROAD = ["clave", "clé", "contrasena", "contraseña", "geheimnis", "jeton", "kennwort", "mdp", "mot de passe", "motdepasse", "passwort", "schlüssel", "schluessel", "secreto", "zugangsdaten"]
_ALL_KEY_WORDS = frozenset(KEY_WORDS + KEY_WORDS_ABROAD + ["passe"])
_NAME = re.compile(rf"[\w.-]*(?:{'|'.join(KEY_WORDS + KEY_WORDS_ABROAD)})[\w.-]*[\"'`\])]{{0,2}}[ \t]*$", re.IGNORECASE)
#: The password of an address, and the marks of a private key.
_IN_ADDRESS = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,30}://[^\s:/@\"'`]{0,64}:(?P<value>[^\s/@\"'`]+)@")
_PRIVATE = re.compile(r"-----BEGIN (?P<kind>[A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?)-----")
_SIGN = re.compile(r"(?:=>|:=|=+|:)[ \t]*")
_SCHEME = re.compile(r"(?:basic|bearer|token)[ \t]+(?=\S)", re.IGNORECASE)
_QUOTED = re.compile(r"(?P<q>[\"'`])(?P<value>[^\n]+?)(?P=q)")
_BARE = re.compile(r"[\"'`]?(?P<value>(?:(?!&[A-Za-z_]+=)[^\s\"'`])+)")
_PREFIX = re.compile(r"(?<![A-Za-z0-9])(?:A[KS]IA|AIza|eyJ|gh[opsur]_|github_pat_|glpat-|hf_|npm_|[prs]k[_-]|sk-ant-|sk-proj-|xapp-|xox[abeprs]-|ya29\.|SG\.|dop_v1_|shpat_)[A-Za-z0-9_.+/=-]*[A-Za-z0-9_=]")
_PIECE = re.compile(r"[a-zà-ÿ]+")
_BESIDE = re.compile(r"[^\W_]+")
_CLASSES = np.zeros(256, np.int8)
_CLASSES[list(b"0123456789")], _CLASSES[list(range(65, 91))], _CLASSES[list(range(97, 123))] = 1, 2, 3


def dictionary(path: str | None = None) -> frozenset[str]:
    """Whole words of three letters or more of a public vocabulary (a JSON file of `tokenizers`), and the frequent words of four languages."""
    with open(path or public_tokenizers.path("byte_bpe_50k.json")) as f:
        entries = json.load(f)["model"]["vocab"]
    whole = {e[1:].lower() for e in entries if e.startswith("Ġ") and len(e) > 3 and e[1:].isascii() and e[1:].isalpha()}
    return frozenset(whole | {w for ws in STOP_WORDS.values() for w in ws if len(w) > 2})


def covered(s: str, words: frozenset[str]) -> int:
    """How many characters of s words can cover, without overlaps, in each run of letters for itself. Words are of 3 to 16 letters; a run over 256 letters counts for none, as no phrase is one."""
    total = 0
    for m in _PIECE.finditer(s.lower()):
        run = m.group()
        if len(run) > 256:
            continue
        best = [0] * (len(run) + 1)
        for end in range(1, len(run) + 1):
            best[end] = max([best[end - 1]] + [best[end - k] + k for k in range(3, min(16, end) + 1) if run[end - k : end] in words])
        total += best[-1]
    return total


def private_keys(text: str) -> list[tuple[int, int]]:
    """From the first mark of a private key to its last; of a key that is cut off the lines that follow its mark."""
    out, at = [], 0
    while m := _PRIVATE.search(text, at):
        close = f"-----END {m['kind']}-----"
        end = text.find(close, m.end())
        nxt = text.find("-----BEGIN ", m.end())
        if end < 0 or 0 <= nxt < end:
            end = m.end()
            while tail := _KEY_LINE.match(text, end):
                end = tail.end()
        else:
            end += len(close)
        out.append((m.start(), end))
        at = end
    return out


_KEY_LINE = re.compile(r"\s*[A-Za-z0-9+/]{16,}={0,2}")


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) in characters: key characters with a digit and, where there is a name before an equals sign, what follows that; values of names with a key word; known prefixes; passwords in addresses; private keys, in which nothing else is looked for."""
    keys = private_keys(text)
    if keys:  # what lies in a key is the key's
        inside = [c for c in candidates(_blanked(text, keys))]
        return sorted([*keys, *inside])
    out = set(named_values(text))
    out.update(m.span() for m in _PREFIX.finditer(text))
    out.update(m.span("value") for m in _IN_ADDRESS.finditer(text))
    for run in _RUN.finditer(text):
        for m in _KEY.finditer(text, run.start(), run.end()):
            start = m.start()
            if (name := text.find("=", max(0, start - 1), m.end() - 12)) > 0:
                start = name + 1
            if any("0" <= c <= "9" for c in text[start : m.end()]):
                out.add((start, m.end()))
    return sorted(out)


def _blanked(text: str, spans: list[tuple[int, int]]) -> str:
    parts, at = [], 0
    for a, b in spans:
        parts += [text[at:a], " " * (b - a)]
        at = b
    return "".join([*parts, text[at:]])


def named_values(text: str) -> list[tuple[int, int]]:
    """(start, end) of what is assigned to a name with a key word, without quotes and what ends a sentence."""
    out, at = [], 0
    while sign := _SIGN.search(text, at):
        at = sign.end()
        if not _NAME.search(text, max(0, sign.start() - NAME_CHARS), sign.start()):
            continue
        if scheme := _SCHEME.match(text, at):
            at = scheme.end()
        if m := _QUOTED.match(text, at) or _BARE.match(text, at):
            start, end = m.span("value")
            while m.re is _BARE and end > start and text[end - 1] in ",;.)]}":
                end -= 1
            if end > start:
                out.append((start, end))
            at = m.end()
    return out


#: What stands where a value is to be filled in.
_PLACEHOLDER = re.compile(r"(?:\$\{.*\}|\{\{.*\}\}|<.*>|\*+|x+|\.\.\.|%\(.*|(?:YOUR|MY|THE)_[A-Z_]+)$", re.IGNORECASE)


def features(text: str, start: int, end: int, words: frozenset[str]) -> list[float]:
    s = text[start:end]
    n = len(s)
    codes = np.frombuffer(s.encode("ascii", "replace"), np.uint8)
    kinds = _CLASSES[codes]
    counts = Counter(s)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    before = text[max(0, start - 40) : start]
    left = [w.lower() for w in _BESIDE.findall(before)[-3:]]
    right = [w.lower() for w in _BESIDE.findall(text[end : end + 24])[:1]]
    joined = before.rstrip()[-1:]
    issued, address = _PREFIX.match(text, start), before[-80:].rfind("://")
    return [
        n, entropy, float(np.count_nonzero(kinds[1:] != kinds[:-1])) / n, float(np.count_nonzero(np.diff(codes.astype(int)) == 1)) / n,
        float(np.count_nonzero(kinds == 1)) / n, float(np.count_nonzero(kinds == 2)) / n, float(np.count_nonzero(kinds == 3)) / n, float(np.count_nonzero(kinds == 0)) / n,
        float(all(c in "0123456789abcdefABCDEF" for c in s)), covered(s, words) / n, float(s.count("/")), float(s.count("-")),
        float(text[end : end + 1] in "@./:" and end < len(text)), float(before[-1:] in "@./:" and start > 0), float("//" in before[-12:] or "www" in before[-12:]),
        float(joined in "=:\"'"), float(any(w in _ALL_KEY_WORDS for w in left)), float(any(w in OTHER_WORDS for w in left)), float(bool(right) and right[0] in OTHER_WORDS), float(len(counts)) / n,
        float(issued is not None), float(address >= 0 and ":" in before[address + 3 :] and text[end : end + 1] == "@"), float(s.startswith("-----BEGIN")), float(bool(_PLACEHOLDER.match(s))),
    ]


def made_findings(n: int = 8000, seed: int = 7) -> list[tuple[str, int, int, bool]]:
    """Labelled findings (text, start, end, is a secret): usual forms of keys and of what is taken for one."""
    r = random.Random(seed)
    upper, digits, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "abcdefghijklmnopqrstuvwxyz"
    of = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    syllable = lambda: r.choice("re ti on an er th in st ed ou al en la de men tion".split())
    word = lambda: "".join(syllable() for _ in range(r.randint(1, 4)))
    phrase = lambda: "".join((word() + word()).capitalize() for _ in range(r.randint(3, 5))) if r.random() < 0.5 else "-".join([*(word() for _ in range(r.randint(2, 4))), of(digits, r.randint(2, 4)), word().capitalize()])
    hexed, mixed = "0123456789abcdef", upper + lower + digits
    common = "learn hub download config cache utils name version release model server client index page image build test data main admin report summary".split()
    out = []
    while len(out) < n:
        secret = r.random() < 0.5
        if secret:
            form = r.randrange(14)
            value = ["AKIA" + of(upper + digits, 16), of(hexed, r.choice((18, 32, 40, 64))), of(mixed, r.randint(20, 44)), of(mixed + "+/", 40), "ghp_" + of(mixed, 36), of(mixed + "_-", r.randint(16, 30)),
                "AKIA" + of(upper + "234567", 16) if r.random() < 0.5 else "AKIA" + of(upper, 16), of(lower, r.randint(16, 32)) if r.random() < 0.5 else of(upper + lower, r.randint(16, 32)), phrase(), of(mixed + "!$#%*?", r.randint(8, 16)),
                r.choice(("sk-ant-api03-", "sk-proj-", "sk-", "sk_live_", "xoxb-", "xoxp-", "glpat-", "npm_", "hf_", "AIza", "ghp_", "SG.", "shpat_", "dop_v1_", "xapp-1-")) + "-".join(of(r.choice((mixed, digits)), r.randint(10, 24)) for _ in range(r.randint(1, 3))),
                r.choice((of(mixed, r.randint(8, 24)), of(mixed + "!$#%*?", r.randint(6, 14)), phrase(), of(lower, r.randint(8, 14)))),
                "-----BEGIN " + (k := r.choice(("", "RSA ", "EC ", "OPENSSH "))) + "PRIVATE KEY-----\n" + "\n".join(of(mixed + "+/", 64) for _ in range(r.randint(1, 12))) + f"\n-----END {k}PRIVATE KEY-----",
                "eyJ" + of(mixed, r.randint(16, 40)) + ".eyJ" + of(mixed, r.randint(20, 60)) + "." + of(mixed + "_-", 42) + of(mixed, 1)][form]
            named = form in (1, 2, 3, 5, 7, 8, 9) or r.random() < 0.3
            key = r.choice(KEY_WORDS)
            key = r.choice(KEY_WORDS_ABROAD) if form not in (10, 11) and r.random() < 0.25 else key
            lead = r.choice((f"{key}=", f'{key} = "', f"{key}: ", f"{word()}_{key}=")) if named else ""
            if form == 11:
                lead = f"{r.choice(('postgres', 'mysql', 'mongodb+srv', 'redis', 'https', 'amqp'))}://{r.choice((word(), 'root', 'admin', ''))}:"
        else:
            form = r.randrange(14)
            value = [
                f"{of(hexed, 8)}-{of(hexed, 4)}-{of(hexed, 4)}-{of(hexed, 4)}-{of(hexed, 12)}", of(hexed, 40), of(digits, r.randint(12, 16)), f"{word()}/{word()}{of(digits, 2)}/{word()}{word()}", f"{word()}_{word()}_{word()}{of(digits, 2)}",
                "-".join((of(digits, 4), of(digits, 2), of(digits, 2), of(digits, 4))), word() + word() + word() + of(digits, 1), f"{word()}-{word()}-{word()}-{of(digits, 3)}", of(hexed, 64),
                word(), r.choice((str.lower, str.capitalize, str.upper))(r.choice("changeme enabled false nil no none null required true undefined unknown yes".split())), r.choice((of(digits, r.randint(1, 4)), "${" + word().upper() + "}", f"<{word()}>", f"{word()}_{word()}", f"{r.choice(('MY', 'THE', 'YOUR'))}_{word().upper()}_{word().upper()}", f"{word()}.{word()}()")),
                r.choice(("sk-", "hf_", "npm_", "pk_", "rk-", "sk_", "eyJ")) + "_".join(r.choice(common) for _ in range(r.randint(1, 4))) + r.choice(("", "_v2", "2", "-3.1")),
                r.choice(("${PASSWORD}", "<password>", "***", "password", "xxxx", "changeme", "{{ pw }}", "YOUR_PASSWORD")),
            ][form]
            key = r.choice(KEY_WORDS)
            key = r.choice(KEY_WORDS_ABROAD) if r.random() < 0.25 else key
            lead = f"{r.choice(('postgres', 'mysql', 'redis', 'https'))}://{word()}:" if form == 13 else r.choice(("", "", f"{r.choice(OTHER_WORDS)} ", "import ", "from ")) if form == 12 else r.choice((f"{key}=", f'{key} = "', f"{key}: ", f"{word()}_{key}=")) if form > 8 else r.choice((f"{r.choice(OTHER_WORDS)} ", f"{r.choice(OTHER_WORDS)}: ", "https://example.com/")) if form in (0, 1, 8) else r.choice(("", "https://example.com/", f"{r.choice(OTHER_WORDS)} ", "/"))
        if not secret and form < 9 and (len(value) < 12 or not any(c in digits for c in value)):
            continue  # such a value without a key word before it is no candidate
        head = " ".join(r.choice((word, lambda: r.choice(common)))() for _ in range(r.randint(1, 6))) + " " + lead
        after = f"@{word()}.{r.choice(('com', 'internal', 'net'))}:{of(digits, 4)}/" if lead.endswith(":") and "://" in lead else r.choice((" ", '" ', ". ", ", "))
        out.append((head + value + after + word(), len(head), len(head) + len(value), secret))
    return out


class Forest:
    """Trees in arrays: a row is (feature or -1, threshold, left, right, share of secrets)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = TREE_DEPTH, seed: int = 11):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.trees = []
        for _ in range(trees):
            rows: list[list[float]] = []
            self._grow(rows, x, y, rng.integers(0, len(x), len(x)), depth, rng)
            self.trees.append(np.array(rows))

    def _grow(self, rows, x, y, at, depth, rng) -> int:
        me = len(rows)
        rows.append([-1, 0.0, 0, 0, float(y[at].mean())])
        if depth and len(at) >= 2 * LEAST_LEAF and 0 < rows[me][4] < 1:
            best = None
            for f in rng.choice(x.shape[1], max(1, int(math.sqrt(x.shape[1]))), replace=False):
                order = np.argsort(x[at, f], kind="stable")
                v, ones = x[at, f][order], np.cumsum(y[at][order])
                n = np.arange(1, len(v) + 1)
                cut = np.flatnonzero((v[1:] > v[:-1]) & (n[:-1] >= LEAST_LEAF) & (n[:-1] <= len(v) - LEAST_LEAF))
                if not len(cut):
                    continue
                a, b = n[cut], len(v) - n[cut]
                p, q = ones[cut] / a, (ones[-1] - ones[cut]) / b
                gini = a * p * (1 - p) + b * q * (1 - q)
                k = int(np.argmin(gini))
                if best is None or gini[k] < best[0]:
                    best = (gini[k], f, (v[cut[k]] + v[cut[k] + 1]) / 2)
            if best:
                side = x[at, best[1]] <= best[2]
                rows[me][0], rows[me][1] = int(best[1]), float(best[2])
                rows[me][2] = self._grow(rows, x, y, at[side], depth - 1, rng)
                rows[me][3] = self._grow(rows, x, y, at[~side], depth - 1, rng)
        return me

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for t in self.trees:
            at = np.zeros(len(x), np.int64)
            while len(inner := np.flatnonzero(t[at, 0] >= 0)):
                node = t[at[inner]]
                low = x[inner, node[:, 0].astype(np.int64)] <= node[:, 1]
                at[inner] = np.where(low, node[:, 2], node[:, 3]).astype(np.int64)
            total += t[at, 4]
        return total / len(self.trees)


def sampled(findings: DataFrame, most: int = MOST_FINDINGS) -> list[tuple[str, int, int, bool]]:
    """At most `most` rows of labelled findings (text, start, end, is_secret), by the order of their hashes, each with AROUND characters on either side."""
    near = F.greatest(F.col("start") - AROUND, F.lit(0))
    cut = findings.select(F.substring(F.col("text"), (near + 1).cast("int"), (F.col("end") + AROUND - near).cast("int")).alias("text"), (F.col("start") - near).alias("start"), (F.col("end") - near).alias("end"), "is_secret")
    rows = cut.orderBy(F.xxhash64("text", "start", "end"), "text", "start", "end").limit(most).collect()
    return [(r.text, r.start, r.end, r.is_secret) for r in rows]


def train(findings: list[tuple[str, int, int, bool]] | DataFrame | None = None, vocabulary: str | None = None) -> Forest:
    """A forest from labelled findings, at most MOST_FINDINGS; it keeps the dictionary that it knows words by."""
    found = sampled(findings) if isinstance(findings, DataFrame) else (findings or made_findings())[:MOST_FINDINGS]
    words = dictionary(vocabulary)
    forest = Forest(np.array([features(t, a, b, words) for t, a, b, _ in found]), np.array([float(label) for *_, label in found]))
    forest.words = words
    return forest


def scan(docs: DataFrame, forest: Forest | None = None, threshold: float = 0.5) -> DataFrame:
    """A row for each candidate: doc_id, start and end in characters, the candidate, score, is_secret."""
    shared = docs.sparkSession.sparkContext.broadcast(forest or train())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("candidate", pa.string()), ("score", pa.float64())])

    def find(batches):
        for batch in batches:
            rows, x = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for a, b in candidates(text or ""):
                    rows.append((doc_id, a, b, text[a:b]))
                    x.append(features(text, a, b, shared.value.words))
            if rows:
                yield pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=False)), pa.array(shared.value.score(np.array(x)))], schema=schema)

    small_batches(docs.sparkSession, 8)
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, "doc_id long, start long, end long, candidate string, score double")
    return found.withColumn("is_secret", F.col("score") >= threshold)


def op9_secret_scan(spark, sf_dir):
    """Every candidate of every whole text, with the digest of what it is and the forest's verdict."""
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "start", "end", F.sha2(F.col("candidate").cast("binary"), 256).alias("candidate_sha256"), F.round("score", 6).alias("score"), "is_secret")
