"""Secret scan: fixed patterns, and formats learned from what they find (grammar inference).

Base.  Three fixed patterns find passwords and tokens that are assigned to a name, access keys and long hexadecimal runs.

Formats.  The values found are labelled credentials, the label being the kind.  For each kind a prefix tree of a sample of
different values, with counts, is generalised by state merging: states are visited from the root, and a state whose
continuations are statistically compatible with those of an earlier one (Hoeffding bounds on the shares of stopping, of
every symbol and of every class of symbols, in all states below) is merged with it.  The result is a probabilistic
automaton: fixed parts, like a leading ``AKIA``, stay chains, random tails become loops with the shares of their symbols.
Another automaton of this sort is learned from a sample of ordinary tokens of the texts.

Scan.  Every token of ``MIN_TOKEN`` characters or more that no base span touches is a candidate.  It is scored by its mean
log-likelihood per character under each format.  It is typical of a format if, along its path, neither the likelihood nor
the number of digits, lower-case and upper-case letters departs from what the states passed lead one to expect by more than
``SPREAD`` standard deviations (a number of 16 digits is no typical hexadecimal run, though each digit is likely).  It is a
secret if it is typical of a format and that explains it better, by ``MARGIN``, than the ordinary automaton.  Such spans are added as ``like_<kind>``; base spans stay.

Scale.  One pass over the texts finds base spans and candidates; they are written to a table with little text in it.  The
automata are learned on the driver from bounded samples: ``SAMPLE`` different values of each kind and of ordinary tokens,
those with the lowest hashes, of up to ``SAMPLE_CHARS`` characters; ordinary tokens come from one text in ``PLAIN_FOLD``,
of up to ``SAMPLE_TEXT`` bytes.  Candidates are scored in a second, map-only pass over the table.  All counts, spans and candidates cover all texts in full.

Odd rows.  A null text is empty and has no spans; every row gives a row, repeated rows and null ids as well.  A kind with
fewer than ``MIN_SAMPLE`` different values has no format and adds no spans; so does a corpus without ordinary tokens.
Places are code points; malformed UTF-8 is read as U+FFFD, one per bad sequence.  Very long texts and tokens are read
whole; memory follows one text.  Columns other than doc_id and text, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.textvec import slices, utf8
from strata.llm.workspace import Workspace

#: fixed values: the kinds in the order in which spans of one start are listed, and their patterns and least lengths
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")   # a run of 32 or more: shorter runs fail in any case
ASSIGN_CHARS, ACCESS_CHARS = 8, 16

#: a candidate: a run of credential characters, padding of base64 included
MIN_TOKEN = 16
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: ordinary tokens; one text in so many, by its hash, and of so many bytes at most, gives some for the sample
PLAIN = re.compile(r"[A-Za-z0-9+/_-]{4,}")
PLAIN_FOLD, SAMPLE_TEXT = 32, 1 << 20
#: sample bounds: different values of a kind (and ordinary tokens), characters of one, and least number of values
SAMPLE, SAMPLE_CHARS, MIN_SAMPLE = 1000, 128, 8
#: confidence of the merging test: the lower, the more states are merged
ALPHA = 0.05
#: smoothing: weight of the uniform distribution over all symbols at each state
SMOOTHING = 0.5
_SYMBOLS = 66
#: classes of symbols whose shares are compared as well
_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: a candidate may depart this many standard deviations from a format, and must score this much above ordinary text
SPREAD, MARGIN = 3.0, 0.1
#: variance of a log-likelihood that is allowed for besides that of the state: shares are estimates
SLACK = 0.05


# --------------------------------------------------------------------------------------------------- base patterns

def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, kind number, end, value) of the fixed patterns, by start, then kind."""
    found = [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= ACCESS_CHARS]
    found += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple]) -> list[tuple[int, str]]:
    """(start, token) of all tokens that no base span touches."""
    taken = sorted((s, e) for s, _, e, _ in base)
    out, k, reach = [], 0, -1
    for m in TOKEN.finditer(text):
        # base spans that start before the token's end; ``reach`` is the furthest end among them
        while k < len(taken) and taken[k][0] < m.end():
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= m.start():
            out.append((m.start(), m.group()))
    return out


# ------------------------------------------------------------------------------------------------ grammar inference

@dataclass
class Automaton:
    """Probabilistic deterministic automaton: per state its passes, stops, and the count and target of each symbol."""

    passes: list[int] = field(default_factory=lambda: [0])
    stops: list[int] = field(default_factory=lambda: [0])
    edges: list[dict[str, list[int]]] = field(default_factory=lambda: [{}])   # symbol -> [count, state]

    def add(self, value: str) -> None:
        state = 0
        self.passes[0] += 1
        for symbol in value:
            edge = self.edges[state].get(symbol)
            if edge is None:
                edge = self.edges[state][symbol] = [0, len(self.passes)]
                self.passes.append(0)
                self.stops.append(0)
                self.edges.append({})
            edge[0] += 1
            state = edge[1]
            self.passes[state] += 1
        self.stops[state] += 1

    def walk(self, value: str) -> Iterator[float]:
        """Log-likelihood of each symbol and of the stop; smoothed, so that every string has one."""
        state = 0
        for symbol in value:
            edge = self.edges[state].get(symbol)
            yield math.log(((edge[0] if edge else 0) + SMOOTHING / _SYMBOLS) / (self.passes[state] + SMOOTHING))
            if edge:
                state = edge[1]     # a symbol that never came here leaves the state as it is
        yield math.log((self.stops[state] + SMOOTHING / _SYMBOLS) / (self.passes[state] + SMOOTHING))

    def score(self, value: str) -> float:
        """Mean log-likelihood per symbol, the stop included."""
        return sum(self.walk(value)) / (len(value) + 1)


def _differ(f1: int, n1: int, f2: int, n2: int, width: float) -> bool:
    """Hoeffding bound: whether two shares differ more than chance allows."""
    return abs(f1 / n1 - f2 / n2) > width * (n1 ** -0.5 + n2 ** -0.5)


def _compatible(a: Automaton, one: int, two: int, width: float) -> bool:
    """Whether two states, and all states that equal strings lead to from them, have alike continuations."""
    todo = [(one, two)]
    while todo:
        x, y = todo.pop()
        nx, ny = a.passes[x], a.passes[y]
        if _differ(a.stops[x], nx, a.stops[y], ny, width):
            return False
        ex, ey = a.edges[x], a.edges[y]
        for symbol in ex.keys() | ey.keys():
            cx, cy = ex.get(symbol), ey.get(symbol)
            if _differ(cx[0] if cx else 0, nx, cy[0] if cy else 0, ny, width):
                return False
            if cx and cy:
                todo.append((cx[1], cy[1]))
        for members in _CLASSES:
            if _differ(sum(e[0] for c, e in ex.items() if c in members), nx,
                       sum(e[0] for c, e in ey.items() if c in members), ny, width):
                return False
    return True


def _merge(a: Automaton, keep: int, gone: int) -> None:
    """Add a subtree's counts to the automaton at ``keep``; what only the subtree has is hung in."""
    todo = [(keep, gone)]
    while todo:
        x, y = todo.pop()
        a.passes[x] += a.passes[y]
        a.stops[x] += a.stops[y]
        for symbol, (count, target) in a.edges[y].items():
            edge = a.edges[x].get(symbol)
            if edge is None:
                a.edges[x][symbol] = [count, target]
            else:
                edge[0] += count
                todo.append((edge[1], target))


def learn(values: list[str], alpha: float = ALPHA) -> Automaton:
    """Automaton of a list of strings: prefix tree, then merging of compatible states.

    Kept states come in the order of their first visit, breadth first; each new state is merged with the first kept one
    that it is compatible with, or kept.  Only states below kept ones are candidates, so a merged subtree is still a
    tree and folds in one walk.
    """
    a = Automaton()
    for value in sorted(values):
        a.add(value)
    width = math.sqrt(0.5 * math.log(2 / alpha))
    kept, seen, k = [0], {0}, 0
    while k < len(kept):
        state = kept[k]
        fresh = next((s for s in sorted(a.edges[state]) if a.edges[state][s][1] not in seen), None)
        if fresh is None:
            k += 1
            continue
        edge = a.edges[state][fresh]
        for old in kept:
            if _compatible(a, old, edge[1], width):
                target, edge[1] = edge[1], old
                _merge(a, old, target)
                k = 0     # states kept earlier may have got new ones below them
                break
        else:
            kept.append(edge[1])
            seen.add(edge[1])
    place = {s: i for i, s in enumerate(kept)}
    return Automaton([a.passes[s] for s in kept], [a.stops[s] for s in kept],
                     [{c: [n, place[t]] for c, (n, t) in a.edges[s].items()} for s in kept])


class Format:
    """Automaton of a kind, with what each of its states leads one to expect."""

    def __init__(self, values: list[str]):
        a = self.automaton = learn(values)
        self.expected = []   # per state: mean and variance of the log-likelihood, shares of the classes
        for passes, stops, edges in zip(a.passes, a.stops, a.edges):
            shares = [n / passes for n in (stops, *[n for n, _ in edges.values()]) if n]
            mean = sum(p * math.log(p) for p in shares)
            self.expected.append((mean, sum(p * (math.log(p) - mean) ** 2 for p in shares) + SLACK,
                                  [sum(n for c, (n, _) in edges.items() if c in own) / passes for own in _CLASSES]))

    def fit(self, token: str) -> float | None:
        """Mean log-likelihood of a token that is typical of the format, else None."""
        a, state, total, mean, variance = self.automaton, 0, 0.0, 0.0, 0.0
        surplus, spread = [0.0] * len(_CLASSES), [SLACK] * len(_CLASSES)
        for symbol, step in zip([*token, ""], a.walk(token)):
            m, v, shares = self.expected[state]
            total, mean, variance = total + step, mean + m, variance + v
            for i, share in enumerate(shares):
                surplus[i] += (symbol != "" and symbol in _CLASSES[i]) - share
                spread[i] += share * (1 - share)
            edge = a.edges[state].get(symbol)
            state = edge[1] if edge else state
        if total < mean - SPREAD * math.sqrt(variance):
            return None
        if any(abs(d) > SPREAD * math.sqrt(v) for d, v in zip(surplus, spread)):
            return None
        return total / (len(token) + 1)


@dataclass
class Formats:
    """Formats of the kinds, and the automaton of ordinary tokens."""

    kinds: dict[str, Format]
    plain: Automaton | None

    def classify(self, token: str) -> str | None:
        """The kind whose format explains a token best, or None where none does."""
        if self.plain is None:
            return None
        fits = [(fit, k) for k, own in self.kinds.items() if (fit := own.fit(token)) is not None]
        if not fits:
            return None
        best, kind = max(fits)
        return kind if best - self.plain.score(token) >= MARGIN else None


def learn_formats(values: dict[str, list[str]], plain: list[str]) -> Formats:
    """Formats of the kinds with enough different values, and the automaton of ordinary tokens where there are any."""
    own = {kind: sorted(set(values.get(kind, []))) for kind in KINDS}
    return Formats({k: Format(v) for k, v in own.items() if len(v) >= MIN_SAMPLE}, learn(plain) if plain else None)


# ----------------------------------------------------------------------------------------------------- Spark passes

_SPAN = "struct<start:long,kind:int,end:long,value:string>"
_FOUND = f"base array<{_SPAN}>, tokens array<struct<start:long,token:string>>, plain array<string>"
_ARROW_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.string())])
_ARROW_TOKEN = pa.struct([("start", pa.int64()), ("token", pa.string())])


def _plain_tokens(text: str, base: list[tuple]) -> list[str]:
    """Different ordinary tokens of a text: those that no base span touches, of a length that the sample takes."""
    out, k, reach = set(), 0, -1
    for m in PLAIN.finditer(text):
        while k < len(base) and base[k][0] < m.end():
            reach = max(reach, base[k][2])
            k += 1
        if reach <= m.start() and m.end() - m.start() <= SAMPLE_CHARS:
            out.add(m.group())
    return sorted(out)


def find_base(documents: DataFrame, plain_fold: int = PLAIN_FOLD) -> DataFrame:
    """(doc_id, base, tokens, plain): base spans, candidates, and some ordinary tokens of every document."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                base, tokens, plain = [], [], []
                for raw in utf8(part.column("text")):
                    text = raw.decode("utf-8", "replace")
                    spans = base_spans(text)
                    base.append([dict(zip(("start", "kind", "end", "value"), s)) for s in spans])
                    tokens.append([{"start": s, "token": t} for s, t in candidates(text, spans)])
                    sampled = len(raw) <= SAMPLE_TEXT and zlib.crc32(raw) % plain_fold == 0
                    plain.append(_plain_tokens(text, spans) if sampled else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(base, pa.list_(_ARROW_SPAN)),
                     pa.array(tokens, pa.list_(_ARROW_TOKEN)), pa.array(plain, pa.list_(pa.string()))],
                    names=["doc_id", "base", "tokens", "plain"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        find, f"doc_id {kind}, {_FOUND}")


def sample_formats(found: DataFrame, sample: int = SAMPLE) -> Formats:
    """Formats learned from bounded samples of what ``find_base`` has found."""

    def lowest(values: DataFrame) -> list[str]:
        own = values.where(F.length("value") <= SAMPLE_CHARS).distinct()
        return [r["value"] for r in own.orderBy(F.xxhash64("value"), "value").limit(sample).collect()]

    spans = found.select(F.explode("base").alias("s")).select(F.col("s.kind").alias("kind"), F.col("s.value").alias("value"))
    values = {k: lowest(spans.where(F.col("kind") == i).select("value")) for i, k in enumerate(KINDS)}
    return learn_formats(values, lowest(found.select(F.explode("plain").alias("value"))))


_RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(found: DataFrame, formats: Formats) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans): base spans, and candidates that a format explains.

    ``spans`` lists kind:start:end (end exclusive) by start, then by kind: base kinds, then ``like_<kind>``.
    """
    kind = found.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for base, tokens in zip(batch.column("base").to_pylist(), batch.column("tokens").to_pylist()):
                own = [(s["start"], s["kind"], f"{KINDS[s['kind']]}:{s['start']}:{s['end']}") for s in base]
                for i, name in enumerate(KINDS):
                    rows[f"n_{name}"].append(sum(k == i for _, k, _ in own))
                rows["base_sha256"].append(hashlib.sha256(",".join(t for *_, t in own).encode()).hexdigest())
                for t in tokens:
                    like = formats.classify(t["token"])
                    if like:
                        own.append((t["start"], len(KINDS) + KINDS.index(like),
                                    f"like_{like}:{t['start']}:{t['start'] + len(t['token'])}"))
                rows["spans"].append(",".join(t for *_, t in sorted(own)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(rows[f"n_{k}"], pa.int64()) for k in KINDS],
                 pa.array(rows["base_sha256"], pa.string()), pa.array(rows["spans"], pa.string())],
                names=["doc_id", *rows])

    return found.select("doc_id", "base", "tokens").mapInArrow(score, f"doc_id {kind}, {_RESULT}")


def op12_grammar_inference(spark, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "secrets")
    found = work.write(find_base(spark.read.parquet(f"{sf_dir}/documents.parquet")), "found")
    return scan(found, sample_formats(found))
