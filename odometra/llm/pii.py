r"""Personal data by bootstrapped contextual extraction (operator 1).

Base: four fixed expressions find the seeds, in one pass over whole texts that also notes
every other identifier-like token (it holds a digit or @), run of short digit groups and address
in words ("name at host dot org"). Values of 16 or more letters and digits behind the name of
a credential (token = "...") are seeds of a further kind, secret.
Bootstrapping: what surrounds an identifier are its contexts: the word before; the two words
before; the words on both sides; the name before = or :; the label that begins the line; the
characters that touch it, as far as 64; and its own form (sizes of the last digit groups, or the alphabet
and length of a key). A lexical pattern is a context together with a class of values
(numbers, or values with letters). Patterns and instances form a bipartite graph, scored in turns: a
pattern is trusted by the share of its distinct instances that are of a kind, an instance by
the patterns that vouch for it. What trusted patterns place in a kind supports further
patterns, until nothing is added, and its spans are further spans of that kind; base spans
always stay.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, map_in_pandas, materialize, row_key, table

KINDS = ("email", "ip", "card", "phone")
#: Kinds in the order of spans; a value that is a seed of several is of the first.
ALL_KINDS = (*KINDS, "secret")
SECRET = 4
# Names of credentials.
CREDENTIALS = frozenset("token secret password passwd pwd apikey api_key api-key accesskey access_key access-key auth auth_token auth-token private_key client_secret".split())
#: Code points of the shortest token that is looked at; no kind has shorter ones.
SHORTEST = 5
#: Trust that a pattern and an instance need, trusted instances that a pattern needs, and turns (None: until nothing is added).
TRUST, SUPPORT, TURNS = 0.8, 3, None
#: Longest value and context, in code points, that is its own key; longer ones go by their hash.
LONGEST = 64

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts inside a run of digits: the run's own start would match as well, and earlier.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_PIECE = r"[^\x20\x09-\x0D<>\"'=\[\]{}|;,]"
_TOKEN_END = re.compile(rf"[0-9@]{_PIECE}*")
_APART = frozenset(" \t\n\x0b\x0c\r<>\"'=[]{}|;,")
_SCHEME = re.compile(r"[A-Za-z]+:+(?=[^:])")
_GROUP = r"[+(]?[0-9]{1,4}(?:[)./-]+[0-9]{1,4})*\)?"
_GROUPS = re.compile(rf"(?<![^\x20\x09-\x0D]){_GROUP}(?:[\x20\x09]{{1,2}}{_GROUP}(?![^\x20\x09-\x0D.,;:!?]))+")
_DOT = re.compile(r"[\x20\x09]+(?:dot|\(dot\)|\[dot\])[\x20\x09]+[\w-]+", re.I)
_AT = re.compile(r"(?<=[\x20\x09])(?:at|\(at\)|\[at\])[\x20\x09]+[\w-]+", re.I)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LABEL = re.compile(r"[\x20\t]*([^\s:=]{1,64}(?:[\x20\t][^\s:=]{1,64}){0,2})[\x20\t]*:")
_QUOTES = "\"'`([{<*"
_EDGE = "\"'`.,;:!?()[]{}<>|*#$%&=_"


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d - 9 if (d := 2 * int(c)) > 9 else d for c in digits[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Spans as the leftmost non-overlapping matches have them, found from each @ outward."""
    out, end = [], 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            out.append((start, m.end()))
            end = m.end()
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans by kind; failing matches are dropped without a retry."""
    ip = [m.span() for m in _IP.finditer(text) if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split("."))]
    card = [m.span() for m in _CARD.finditer(text) if 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(d)]
    phone = [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return [emails(text), ip, card, phone]


def key(value: str) -> str:
    return value if len(value) <= LONGEST else "#" + hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()


def groups(text: str) -> list[tuple[int, int]]:
    """Spans of several words: runs of digit groups with 5 digits or more, and addresses in words."""
    out = [m.span() for m in _GROUPS.finditer(text) if sum(c.isdigit() for c in m[0]) >= 5]
    for m in _AT.finditer(text):
        end = m.end()
        while dot := _DOT.match(text, end):
            end = dot.end()
        stop = m.start()
        while stop and text[stop - 1] in " \t":
            stop -= 1
        start = stop
        while start and (text[start - 1].isalnum() or text[start - 1] in "_.+-"):
            start -= 1
        if end > m.end() and start < stop:
            out.append((start, end))
    return out


def tokens(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the runs of pieces that hold a digit or @, found from the first of these outward: linear in the text."""
    end = 0
    for m in _TOKEN_END.finditer(text):
        start = m.start()
        while start > end and text[start - 1] not in _APART:
            start -= 1
        end = m.end()
        yield start, end


def shape(value: str) -> str:
    """Letters as a, digits as 9, runs shortened; other characters stay. Long ones by their hash."""
    return key(re.sub(r"9+", "9", re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", value))))


def _word(text: str) -> str:
    return key(re.sub(r"[0-9]+", "0", text.strip(_EDGE + "\"").lower()))


def value_class(value: str) -> str:
    """Numbers and what has letters keep apart: a serial number behind a word says nothing of addresses behind it."""
    return "t" if any(c.isalpha() for c in value) else "d"


def form(value: str) -> str | None:
    """Sizes of the last three digit groups, or alphabet and length of a key; none for other values."""
    if not any(c.isalpha() for c in value):
        sizes = [str(len(g)) for g in re.findall(r"[0-9]+", value)]
        return ("." if "." in value else "") + ",".join(sizes[-3:])
    if len(value) >= 16 and value.isalnum():
        return f"{'hex' if re.fullmatch('[0-9a-f]+|[0-9A-F]+', value) else 'key'}{len(value)}"
    return None


class Surroundings:
    """Contexts of spans of one text; its words and lines are told apart once."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.words = [m.span() for m in _WORD.finditer(text)]
        self.starts = [s for s, _ in self.words]
        self.lines = [0, *(m.end() for m in re.finditer("\n", text))]
        self.labels: dict[int, str] = {}
        self.said: dict[int, str] = {}

    def near(self, k: int, step: int) -> Iterator[str]:
        """Words from the k-th on, those that are only punctuation left out; at most four are looked at."""
        for j in range(k, k + 4 * step, step):
            if 0 <= j < len(self.words):
                if j not in self.said:  # many identifiers can stand beside one long word
                    self.said[j] = _word(self.text[slice(*self.words[j])])
                if self.said[j]:
                    yield self.said[j]

    def name(self, start: int) -> str:
        """The name in name = value or name: value."""
        text, i = self.text, start
        while i and (text[i - 1] in _QUOTES or text[i - 1] in " \t"):
            i -= 1
        if not i or text[i - 1] not in ":=":
            return ""
        i -= 1
        while i and (text[i - 1] in _QUOTES or text[i - 1] in " \t"):
            i -= 1
        end = i
        while i and (text[i - 1].isalnum() or text[i - 1] in "_-."):
            i -= 1
        return text[i:end].lower()

    def label(self, start: int) -> str:
        at = self.lines[bisect_right(self.lines, start) - 1]
        if at not in self.labels:
            m = _LABEL.match(self.text, at)
            self.labels[at] = _word(m[1]) if m else ""
        return self.labels[at]

    def contexts(self, start: int, end: int) -> list[str]:
        text = self.text
        k = bisect_right(self.starts, start) - 1
        last = bisect_right(self.starts, end - 1) - 1
        before, after = list(self.near(k - 1, -1))[:2], next(self.near(last + 1, 1), "")
        out = [f"f:{f}"] if (f := form(text[start:end])) else []
        if before:
            out.append(f"w:{before[0]}")
            if len(before) > 1:
                out.append(f"x:{before[1]} {before[0]}")
            if after:
                out.append(f"s:{before[0]}|{after}")
        if name := self.name(start):
            out.append(f"n:{_word(name)}")
        if (label := self.label(start)) and self.lines[bisect_right(self.lines, start) - 1] + len(label) < start:
            out.append(f"l:{label}")
        left, right = text[max(self.starts[k], start - LONGEST) : start], text[end : min(self.words[last][1], end + LONGEST)]
        if left or right:
            out += [f"{side}:{key(re.sub('[0-9]+', '0', glue.lower()))}" for side, glue in (("gl", left), ("gr", right)) if glue.strip(_EDGE)]
        return out


def instances(text: str, base: list[list[tuple[int, int]]]) -> list[tuple]:
    """(kind or None, start, end, value, class, shape, contexts) of seeds and other identifiers."""
    out, taken = [], sorted(s for spans in base for s in spans)
    spans = [(kind, s, e, text[s:e].lower()) for kind, found in enumerate(base) for s, e in found]
    k = reach = 0
    for first, end in tokens(text):
        while k < len(taken) and taken[k][0] < end:
            reach = max(reach, taken[k][1])
            k += 1
        if reach > first:
            continue
        token = text[first:end]
        value = token.strip(_EDGE)
        start = first + token.index(value)
        if scheme := _SCHEME.match(value):  # tel:, mailto:
            start, value = start + scheme.end(), value[scheme.end() :]
        if len(value) >= SHORTEST:
            spans.append((None, start, start + len(value), value.lower()))
    k = reach = 0
    for s, e in sorted(groups(text)):
        while k < len(taken) and taken[k][0] < e:
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= s:
            spans.append((None, s, e, " ".join(text[s:e].lower().split())))
    if not spans:
        return out
    around = Surroundings(text)
    for kind, s, e, value in spans:
        if kind is None and e - s >= 16 and value.isalnum() and not value.isalpha() and not value.isdigit() and around.name(s) in CREDENTIALS:
            kind = SECRET
        out.append((kind, s, e, key(value), value_class(text[s:e]), shape(text[s:e]), around.contexts(s, e)))
    return out


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ("kind", "start", "end", "value", "class", "shape", "contexts")
    for pdf in batches:
        rows = []
        for text in pdf["text"]:
            text = text or ""
            base = base_spans(text)
            joined = ",".join(f"{k}:{s}:{e}" for k, spans in zip(KINDS, base, strict=True) for s, e in spans)
            found = [dict(zip(names, x, strict=True)) for x in instances(text, base)]
            rows.append((*map(len, base), hashlib.sha256(joined.encode()).hexdigest(), found))
        yield pd.concat([pdf[["doc_id", "row"]].reset_index(drop=True), pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "found"])], axis=1)


def discover(found: DataFrame, *, trust: float, support: int, turns: int | None) -> DataFrame:
    """(value, shape, kind) of identifiers that trusted patterns place in a kind.

    found has kind (a number in ALL_KINDS, null for none), value, class, shape, contexts. Edges
    are counted once per pattern and value, so a context or a value that fills a third of the
    table weighs as one. A discovered identifier keeps the kind and score of its turn, so the
    turns only add and come to an end. Of equal votes the kind that is listed first wins.
    """
    edges = found.select(F.explode("contexts").alias("context"), F.col("class").alias("of"), "shape", "value", "kind")
    edges = materialize(edges.groupBy(F.concat_ws("\t", "of", "context").alias("context"), "shape", "value").agg(F.min("kind").alias("kind")))
    known = edges.select("value", "shape", F.col("kind").alias("best"), F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0).alias("score")).groupBy("value", "shape").agg(F.min("best").alias("best"), F.max("score").alias("score"))
    reached, turn = known.where("score > 0").count(), 0
    while turns is None or turn < turns:
        scored = edges.select("context", "value", "shape").join(known, ["value", "shape"])
        sizes = scored.groupBy("context").agg(F.count("*").alias("n"))
        patterns = scored.where("best is not null").groupBy("context", "best").agg(F.sum("score").alias("good"), F.sum(F.when(F.col("score") >= trust, 1).otherwise(0)).alias("seeds"))
        trusted = patterns.join(sizes, "context").withColumn("trust", F.col("good") / F.col("n")).where((F.col("trust") >= trust) & (F.col("seeds") >= support)).select("context", F.col("best").alias("vouched"), "trust")
        votes = scored.where("best is null").join(trusted, "context").groupBy("value", "shape", "vouched").agg(F.least(1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-6))))), F.lit(0.999)).alias("vote"))  # 1 is for seeds
        top = votes.groupBy("value", "shape").agg(F.max(F.struct("vote", (-F.col("vouched")).alias("minus"))).alias("top")).select("value", "shape", (-F.col("top.minus")).alias("new"), F.col("top.vote").alias("vote"))
        following = materialize(known.join(top, ["value", "shape"], "left").select("value", "shape", F.coalesce("best", "new").alias("best"), F.when(F.col("best").isNotNull(), F.col("score")).otherwise(F.coalesce("vote", "score")).alias("score")))
        discard(known)
        known = following
        before, reached, turn = reached, known.where("score > 0").count(), turn + 1
        if reached == before:
            break
    return known.where((F.col("score") >= trust) & (F.col("score") < 1) & F.col("best").isNotNull()).select("value", "shape", F.col("best").alias("new_kind"))


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", trust: float = TRUST, support: int = SUPPORT, turns: int | None = TURNS) -> DataFrame:
    """Personal data of every whole text, a row per input row.

    (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans): counts and
    hash are those of the base spans; spans lists kind:start:end of base, secret and discovered
    spans in code points, end exclusive; of discovered spans inside one another the longest;
    n_added counts those beyond the base and n_spans all. Null and empty texts have none; rows
    that repeat an id keep their own spans; an empty table gives no rows. An added span never
    overlaps a base span. A pattern below `support` trusted instances or below `trust`
    discovers nothing.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("row", row_key(F.col("doc_id"), F.col("text")))
    item = "struct<kind:int,start:long,end:long,value:string,class:string,shape:string,contexts:array<string>>"
    scanned = materialize(map_in_pandas(named, _scan, f"doc_id long, row binary, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, found array<{item}>"))
    found = scanned.select("row", F.explode("found").alias("f")).select("row", "f.*")
    new = discover(found, trust=trust, support=support, turns=turns)
    span = "array<struct<kind:int,start:long,end:long>>"
    added = found.where("kind is null").join(new, ["value", "shape"]).groupBy("row", "start", "end").agg(F.collect_set("new_kind").alias("kinds"))
    # what holds a span begins before it, or there and ends later
    before = Window.partitionBy("row").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    added = added.withColumn("reach", F.max("end").over(before)).where(F.col("reach").isNull() | (F.col("reach") < F.col("end")))
    added = added.select("row", F.explode("kinds").alias("kind"), "start", "end").groupBy(F.col("row").alias("added_row")).agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    joined = scanned.join(added, F.col("row") == F.col("added_row"), "left")
    seeds = F.transform(F.filter("found", lambda f: f["kind"].isNotNull()), lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end")))
    joined = joined.withColumn("all", F.array_sort(F.concat(seeds, F.coalesce("added", F.array().cast(span)))))
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    shown = F.array_join(F.transform("all", lambda f: F.concat_ws(":", F.get(names, f["kind"]), f["start"].cast("string"), f["end"].cast("string"))), ",")
    n = F.size("all").cast("long")
    return joined.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", shown.alias("spans"), (n - F.col("n_email") - F.col("n_ip") - F.col("n_card") - F.col("n_phone")).alias("n_added"), n.alias("n_spans"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
