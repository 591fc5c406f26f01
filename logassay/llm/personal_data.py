"""Personal data: fixed patterns, and a skip-chain conditional random field around them.

The patterns give the base spans, which always stay. Values assigned to a name
like ``token`` or ``password`` are secrets; they are evidence like base spans,
and are told as added spans. The field labels tokens that hold a digit or an at
sign (all others are outside by definition) with a kind, as a secret, or with
none. Its factors are a token's shape, the word before it, its neighbour in the
text, and, as skip chains, hubs for all its occurrences in the document. Tokens
are the same with the same letters and digits, numbers with the same last seven
digits, and long numbers with one digit between them. Tokens inside evidence are
given, and so are the hubs of such tokens; loopy message passing carries the
labels to the rest, all documents of a slice at once, each until its messages
rest. Adjacent tokens of one kind that are sure enough become added spans.

Weights are trained piecewise: each factor is a table, so its weights are
smoothed log frequencies of the given labels over all documents, summed by Spark.
Shapes leave out what the patterns go by (the plus of a phone number, the check
digit of a card), so they learn what such numbers look like without it, and
tokens without evidence that a hub links to some teach nothing; that a hub's
tokens agree is assumed before any are counted (``CONSISTENT``). Words before
tokens are hashed to ``CONTEXTS`` cells. The shape table has every shape. Its
``shapes`` most frequent ones travel with the tasks; documents with others get
those by a join, so the number changes no result.

Results: null and empty texts have no spans; rows are independent, so repeated
rows, ties and extra columns change nothing; texts are searched whole; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.llm.common import map_texts, stored, texts_of

KINDS = ("email", "ip", "card", "phone")
SECRET = len(KINDS)
NAMES = (*KINDS, "secret")
NONE = len(NAMES)
LABELS = NONE + 1
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
ASSIGNED = re.compile(
    r"(?i)(?:token|secret|password|passwd|pwd|bearer|(?:api|access|private|secret)[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?"
    r"([A-Za-z0-9_+/=.~-]{16,512})"
)
BEFORE = re.compile(r"([^\W\d_]{1,20})[\W_]{0,4}$")
CONTEXTS = 1 << 14
SMOOTHING = 0.1
# Words before tokens weigh little until they were seen a few times.
CONTEXT_SMOOTHING = 5.0
# Occurrences of one number that are taken to have agreed before any are counted.
CONSISTENT = 100.0
GIVEN = -30.0
RESTING = 1e-4
DAMPING = 0.5
# After so many rounds, and four for each link of the document, when a message has passed
# all of them, steps shrink, so that messages that swing come to rest too. Those that still
# do not, after ``LAST`` times as many, stay at what they swing around.
STEADY, LAST = 200, 10

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches around each at sign, in one pass."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        left = text[done:at]
        size = len(left) - len(left.rstrip(LOCAL))
        right = DOMAIN.match(text, at) if size else None
        if right:
            out.append((0, at - size, right.end()))
        done = right.end() if right else at + 1
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, by kind and start."""
    out = emails(text)
    for m in ADDRESS.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in DIGITS.finditer(text):
        digits = re.sub("[ -]", "", m[0]) if m.end() - m.start() <= 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return out


def secrets(text: str, spans: list[Span]) -> list[Span]:
    """Assigned values of letters and digits that no base span touches."""
    out = []
    for m in ASSIGNED.finditer(text):
        start, end = m.span(1)
        value = m[1]
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            if not any(s < end and start < e for _, s, e in spans):
                out.append((SECRET, start, end))
    return out


def shape(token: str) -> str:
    """Runs of letters and digits by kind and length class, other characters as they are, without a plus
    in front. Long tokens that change often between letters and digits are told by length alone."""
    if len(token) > 600:
        return "long"
    runs = re.findall(r"[0-9]+|[^\W\d_]+", token)
    if len(runs) >= 4 and sum(map(len, runs)) >= 16:
        return f"mixed{min(9, len(token) // 8)}"

    def run(m: re.Match) -> str:
        n = len(m[0])
        if m[0][0].isalpha():
            return "a"
        return "d" + (str(n) if n <= 4 else "5" if n <= 8 else "9" if n <= 12 else "13" if n <= 19 else "20")

    return re.sub(r"[0-9]+|[^\W\d_]+", run, token.removeprefix("+"))[:40]


def context(text: str, start: int) -> int:
    """A cell for the word before a place, 0 if there is none near."""
    m = BEFORE.search(text[max(0, start - 26) : start])
    return 1 + zlib.crc32(m[1].casefold().encode()) % (CONTEXTS - 1) if m else 0


def tokens(text: str) -> list[tuple[int, int]]:
    """Bounds of the tokens the field labels, without punctuation around them."""
    out = []
    for m in TOKEN.finditer(text):
        core = m[0].rstrip(".,;:!?%#$&*\"'|)>]}") + (")" if re.search(r"\([0-9]+\)\W*$", m[0]) else "")
        core = core if m[0].startswith(core) else m[0]
        skip = len(core) - len(core.lstrip("\"'|<[{*#$%&"))
        if skip < len(core):
            out.append((m.start() + skip, m.start() + len(core)))
    return out


def same_keys(token: str) -> list[str]:
    """Tokens that share a key are linked: equal letters and digits, the last seven digits of a number,
    and all digits but one of a long number."""
    digits = re.sub("[^0-9]", "", token)
    if "@" in token or not 7 <= len(digits) <= 40 or re.search(r"[^\W\d_]", token):
        return [re.sub(r"\W", "", token).casefold()]
    if len(digits) < 10:
        return [digits[-7:]]
    near = [f"{digits[:i]}?{digits[i + 1:]}" for i in range(len(digits))]
    return [digits[-7:] if len(digits) <= 15 else digits, *near]


class Graph:
    """Tokens of several documents with their shapes, base labels and links, and hubs of equal tokens."""

    def __init__(self, texts: list[str]):
        self.bounds: list[tuple[int, int, int]] = []
        self.shapes: list[str] = []
        self.contexts: list[int] = []
        self.label: list[int] = []
        self.chain: list[tuple[int, int]] = []
        self.hubs: list[list[int]] = []
        self.base = [base_spans(t) for t in texts]
        self.secrets = [secrets(t, b) for t, b in zip(texts, self.base, strict=True)]
        for d, text in enumerate(texts):
            spans = sorted((s, e, k) for k, s, e in [*self.base[d], *self.secrets[d]])
            same: dict[str, list[int]] = {}
            at = 0
            for start, end in tokens(text):
                i, token = len(self.bounds), text[start:end]
                while at < len(spans) and spans[at][1] <= start:
                    at += 1
                inside = at < len(spans) and spans[at][0] < end
                self.label.append(spans[at][2] if inside else NONE)
                if i and self.bounds[-1][0] == d and start - self.bounds[-1][2] <= 1:
                    self.chain.append((i - 1, i))
                for key in same_keys(token):
                    if len(key) > 3:
                        same.setdefault(key, []).append(i)
                self.bounds.append((d, start, end))
                self.shapes.append(shape(token))
                self.contexts.append(context(text, start))
            # A near number's hub counts if it has more than the equal ones, which have their own.
            linked = set()
            for x in same.values():
                if len(x) > 1 and tuple(x) not in linked:
                    linked.add(tuple(x))
                    self.hubs.append(x)

    def kinds_of(self, hub: list[int]) -> Counter[int]:
        """Occurrences by the kind that base spans give them."""
        return Counter(self.label[i] for i in hub if self.label[i] != NONE)

    def open_tokens(self) -> set[int]:
        """Tokens without evidence that are linked to some: what they are is the field's question, so they
        do not teach it."""
        return {i for hub in self.hubs if self.kinds_of(hub) for i in hub if self.label[i] == NONE}

    def skips(self, opened: set[int]) -> list[tuple[int, int]]:
        """Labels of every hub and its occurrences, without the occurrence the hub has its label from."""
        out = []
        for hub in self.hubs:
            kinds = self.kinds_of(hub)
            own = min(kinds, key=lambda k: (-kinds[k], k)) if kinds else NONE
            rest = Counter(self.label[i] for i in hub if i not in opened)
            rest[own] -= 1
            out += [(own, k) for k in rest.elements()]
        return out


class Weights:
    """Log factors: those of the frequent shapes, and of any shape from its counts."""

    def __init__(
        self, label: np.ndarray, shapes: dict[str, list[int]], pairs: dict[str, list[tuple[int, int, int]]],
        contexts: dict[int, list[int]] | None = None,
    ):
        self.prior = (label + SMOOTHING) / (label + SMOOTHING).sum()
        self.shape = self.factors(shapes)
        self.context = {
            # What was seen against what the labels' shares let expect.
            k: np.log((np.array(v) + CONTEXT_SMOOTHING) / (sum(v) * self.prior + CONTEXT_SMOOTHING))
            for k, v in (contexts or {}).items()
        }
        self.pair = {}
        for name in ("chain", "skip"):
            table = np.zeros((LABELS, LABELS))
            for one, two, n in pairs.get(name, []):
                table[one, two] += n
                table[two, one] += n
            table += SMOOTHING + (CONSISTENT * np.eye(LABELS) if name == "skip" else 0)
            side = table.sum(axis=1)
            self.pair[name] = np.log(table * table.sum() / np.outer(side, side))
            if name == "skip":
                self.hub = np.log(side / side.sum())

    def factors(self, counts: dict[str, list[int]]) -> dict[str, np.ndarray]:
        """Log factors of shapes from their counts by label."""
        return {
            k: np.log((np.array(v) + SMOOTHING * self.prior) / (sum(v) + SMOOTHING)) for k, v in counts.items()
        }

    def posterior(self, graph: Graph, rare: dict[str, np.ndarray]) -> np.ndarray:
        """Label probabilities of every token, by loopy message passing."""
        given = np.array(graph.label)
        unary = np.array([self.shape[s] if s in self.shape else rare[s] for s in graph.shapes])
        unary += np.array([self.context.get(c, np.zeros(LABELS)) for c in graph.contexts])
        fixed = np.flatnonzero(given != NONE)
        unary[fixed] = GIVEN
        unary[fixed, given[fixed]] = 0
        n = len(given)
        hubs = np.array([self.hub_unary(graph.kinds_of(x)) for x in graph.hubs]).reshape(-1, LABELS)
        skip = [(n + h, i) for h, x in enumerate(graph.hubs) for i in x]
        links = [*graph.chain, *skip]
        if links:
            unary = np.concatenate([unary, hubs])
            pair = np.concatenate(
                [np.broadcast_to(self.pair[k], (len(x), LABELS, LABELS)) for k, x in (("chain", graph.chain), ("skip", skip))]
            )
            one = np.array(links)
            doc = np.array([graph.bounds[i][0] for _, i in links])
            np.add.at(unary, *self.messages(unary, one, pair, doc))
        p = np.exp(unary[:n] - unary[:n].max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def hub_unary(self, kinds: Counter[int]) -> np.ndarray:
        """A hub has the kinds that base spans give its tokens, if they give any."""
        if not kinds:
            return self.hub
        out = np.full(LABELS, GIVEN)
        for k, n in kinds.items():
            out[k] = np.log(n / kinds.total())
        return out

    @staticmethod
    def messages(
        unary: np.ndarray, links: np.ndarray, pair: np.ndarray, doc: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Targets and messages of both directions of every link; a document is done when its messages rest."""
        targets, resting = [], []
        sent = np.zeros((2, len(links), LABELS))
        turn = 0
        while len(links):
            source, target = np.concatenate([links, links[:, ::-1]]).T
            both, back = np.concatenate([pair, pair]), np.roll(np.arange(len(source)), len(links))
            steady = STEADY + 4 * np.bincount(doc)[np.concatenate([doc, doc])][:, None]
            flat, moved = sent.reshape(-1, LABELS), np.zeros(doc.max() + 1)
            while True:
                belief = unary.copy()
                np.add.at(belief, target, flat)
                rest = (belief[source] - flat[back])[:, :, None] + both
                top = rest.max(axis=1)
                new = top + np.log(np.exp(rest - top[:, None]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                lack = new - flat
                flat = flat + (1 - DAMPING) * np.minimum(1, steady / (turn + 1)) * lack
                turn += 1
                # A message rests when it is what its sender would send, not when steps are small.
                moved[:] = 0
                np.maximum.at(moved, np.concatenate([doc, doc]), np.abs(lack).max(axis=1))
                done = (moved[doc] <= RESTING) | (turn > LAST * steady[: len(doc), 0])
                if done.any():
                    break
            sent = flat.reshape(2, -1, LABELS)
            targets += [links[done, 1], links[done, 0]]
            resting += [sent[0, done], sent[1, done]]
            links, pair, doc, sent = links[~done], pair[~done], doc[~done], sent[:, ~done]
        return np.concatenate(targets), np.concatenate(resting)


def trained(docs: DataFrame, shapes: int = 4096) -> tuple[Weights, DataFrame | None]:
    """Weights from the base labels of all documents, and the counts of the shapes they do not hold."""

    def work(raw: list[bytes], _: dict) -> dict:
        graph = Graph([t.decode() for t in raw])
        found: Counter[tuple[str, str, int, int]] = Counter()
        opened = graph.open_tokens()
        taught = [i for i in range(len(graph.label)) if i not in opened]
        # Shapes of open tokens are listed too, with nothing learned.
        found.update({("shape", graph.shapes[i], NONE, 0): 0 for i in opened})
        found.update(("shape", graph.shapes[i], graph.label[i], 0) for i in taught)
        found.update(("context", str(graph.contexts[i]), graph.label[i], 0) for i in taught if graph.contexts[i])
        found.update(("chain", "", graph.label[a], graph.label[b]) for a, b in graph.chain if not {a, b} & opened)
        found.update(("skip", "", a, b) for a, b in graph.skips(opened))
        keys = list(found)
        return {
            "factor": pa.array([k[0] for k in keys], pa.string()),
            "shape": pa.array([k[1] for k in keys], pa.string()),
            "one": pa.array([k[2] for k in keys], pa.int32()),
            "two": pa.array([k[3] for k in keys], pa.int32()),
            "n": pa.array([found[k] for k in keys], pa.int64()),
        }

    rows = map_texts(
        docs.select("text"), "factor string, shape string, one int, two int, n long", work
    )
    summed = stored(
        rows.groupBy("factor", "shape", "one", "two").agg(F.sum("n").alias("n")), "pii-factors"
    )
    shape_rows, pairs, contexts = summed.where("factor = 'shape'"), {}, {}
    # Chains and hubs have LABELS^2 rows each, contexts at most CONTEXTS * LABELS.
    for r in summed.where("factor <> 'shape'").collect():
        if r.factor == "context":
            contexts.setdefault(int(r["shape"]), [0] * LABELS)[r.one] += r.n
        else:
            pairs.setdefault(r.factor, []).append((r.one, r.two, r.n))
    label = np.zeros(LABELS)
    for r in shape_rows.groupBy("one").agg(F.sum("n").alias("n")).collect():
        label[r.one] = r.n
    table = stored(
        shape_rows.groupBy("shape").agg(
            F.array(*[F.sum(F.when(F.col("one") == k, F.col("n")).otherwise(0)) for k in range(LABELS)]).alias("counts"),
            F.sum("n").alias("n"),
        ),
        "pii-shapes",
    )
    top = {r["shape"]: r.counts for r in table.orderBy(F.desc("n"), "shape").limit(shapes).collect()}
    return Weights(label, top, pairs, contexts), table.select("shape", "counts") if table.count() > len(top) else None


def added_spans(
    texts: list[str], graph: Graph, weights: Weights, least: float, rare: dict[str, np.ndarray]
) -> list[list[Span]]:
    """The secrets, and runs of adjacent sure tokens of a kind that no evidence touches."""
    out: list[list[Span]] = [list(x) for x in graph.secrets]
    if not graph.bounds:
        return out
    p = weights.posterior(graph, rare)
    best = p.argmax(axis=1)
    sure = (best != NONE) & (p.max(axis=1) >= least) & (np.array(graph.label) == NONE)
    linked = {b for _, b in graph.chain}
    i = 0
    while i < len(best):
        if not sure[i]:
            i += 1
            continue
        j = i + 1
        while j < len(best) and sure[j] and best[j] == best[i] and j in linked:
            j += 1
        d, start, end = graph.bounds[i][0], graph.bounds[i][1], graph.bounds[j - 1][2]
        piece = texts[d][start:end]
        if "@" in piece or best[i] == SECRET or sum(c.isdigit() for c in piece) >= 7:
            out[d].append((int(best[i]), start, end))
        i = j
    return out


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{NAMES[k]}:{s}:{e}" for k, s, e in sorted(spans))


def personal_data(docs: DataFrame, least: float = 0.95, shapes: int = 4096) -> DataFrame:
    """doc_id, counts of the base spans by kind, their digest, and all spans of every row."""
    df = texts_of(docs, "doc_id", "text")
    weights, table = trained(df, shapes)
    whole = table is None
    kind = df.schema["doc_id"].dataType.simpleString()

    def unknown(text: str) -> list[str]:
        return sorted({shape(text[a:b]) for a, b in tokens(text)} - weights.shape.keys())

    def work(raw: list[bytes], rest: dict) -> dict:
        texts = [t.decode() for t in raw]
        own = [whole or "told" in rest or not unknown(t) for t in texts]
        texts = [t if o else "" for t, o in zip(texts, own, strict=True)]
        graph = Graph(texts)
        told = {m["shape"]: m["counts"] for row in rest.get("told", []) for m in row}
        more = added_spans(texts, graph, weights, least, weights.factors(told))
        out: dict[str, list] = {"doc_id": rest["doc_id"], "own": own}
        for k, name in enumerate(KINDS):
            out[f"n_{name}"] = [sum(s[0] == k for s in base) for base in graph.base]
        out["base_sha256"] = [hashlib.sha256(_listed(base).encode()).hexdigest() for base in graph.base]
        out["spans"] = [_listed([*base, *extra]) for base, extra in zip(graph.base, more, strict=True)]
        return out

    counts = ", ".join(f"n_{name} long" for name in KINDS)
    schema = f"doc_id {kind}, {counts}, base_sha256 string, spans string, own boolean"
    known = map_texts(df, schema, work).where("own").drop("own")
    if whole:
        return known

    def sought(raw: list[bytes], rest: dict) -> dict:
        texts = [t.decode() for t in raw]
        rare = pa.array([unknown(t) for t in texts], pa.list_(pa.string()))
        return {**rest, "text": texts, "rare": rare}

    # Documents with shapes they must be told; the others are not shuffled.
    pending = stored(
        map_texts(
            df.withColumn("row", F.monotonically_increasing_id()),
            f"doc_id {kind}, row long, text string, rare array<string>", sought,
        ).where(F.size("rare") > 0),
        "pii-rare",
    )
    told = (
        pending.select("row", F.explode("rare").alias("shape"))
        .join(table, "shape")
        .groupBy("row")
        .agg(F.collect_list(F.struct("shape", "counts")).alias("told"))
    )
    apart = pending.select("doc_id", "text", "row").join(told, "row").drop("row")
    return known.unionByName(map_texts(apart, schema, work).drop("own"))
