"""Problem 1 - speech transcripts into clean speaker turns.

Method: speaker labels are normalised to names; within each transcript the names are
clustered by initials and string similarity with union-find, the participants of the
call being members of clusters of their own: a name joins the cluster of the member it
fits best, participant or variant, and the others cluster among themselves. A label
stands for the participant of its cluster. Turns are collapsed under the canonical
speaker in spoken order.

Rows are cleaned by JVM expressions. Python sees each distinct label once, and of a
call its participants and the distinct names in its labels, never its rows. A call is
put in order in blocks of characters: what a block needs from those before it (who
spoke last, how many turns began) is a small table summed up over the blocks, so one
very long call spreads over many tasks.

Defined results: rows of the same call and char_start are one row, the smallest
turn_id stands for it; rows without char_start come last in their call, by
turn_id, and are never merged. Null, empty and annotation-only texts hold no
speech. A blank or continuation label, and one without letters, is the speaker
who spoke last; before anybody spoke the speaker is unknown (null participant).
A label that fits several participants is given to those of the row's role, then
to the smallest participant_id. A label that fits nobody is a speaker of its own
with a null participant. Rows without a call_id form one call. Columns beyond
the named ones don't matter.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, merge_join

BLOCK_CHARS = 1 << 20

# The vocabulary of transcripts.
MODERATOR_LABELS = frozenset(("operator", "moderator", "host", "coordinator", "conference operator", "conference coordinator"))
CONTINUATION = frozenset(("contd", "cont", "cont d", "continued", "continues", "continuing", "same", "same speaker"))
TITLES = frozenset(("mr", "ms", "mrs", "miss", "dr", "prof", "shri", "smt", "sir"))
ROLE_WORDS = {
    "management": ("management", "mgmt", "company", "executive"),
    "analyst": ("analyst", "investor", "participant"),
    "moderator": ("moderator", "operator", "host", "coordinator"),
}
_SOUNDS = (
    r"(?:inaudible|indiscernible|unintelligible|laugh\w*|laughter|chuckles?|coughs?|coughing|applause|music|noise|silence|pause|crosstalk|"
    r"background noise|overlapping(?: voices| speech| conversation)?|line breaks?|line drops?|audio \w+|technical \w+|no response|ph|phonetic|sic)"
)

_TIME = (
    r"<\s*\d{1,2}:\d{2}(?::\d{2})?(?:\.\d+)?\s*>|\[\s*\d{1,2}:\d{2}(?::\d{2})?(?:\.\d+)?\s*\]|\(\s*\d{1,2}:\d{2}(?::\d{2})?(?:\.\d+)?\s*\)"
    r"|\[\s*(?:\d{1,2}h)?\d{1,3}m\d{1,2}s\s*\]|@\s?\d{1,2}:\d{2}(?::\d{2})?\b|(?<![\d:])\d{1,2}:\d{2}:\d{2}(?:\.\d+)?(?![\d:])(?:\s*-(?=\s|$))?"
)
_NOTE = (
    r"\[[^\[\]]*\]|\{[^{}]*\}|</?[A-Za-z][^<>]*>|\*[A-Za-z][A-Za-z ]*\*|\(\([^()]*\)\)|[♪♫]"
    rf"|(?i:\(\s*{_SOUNDS}\s*\))"
)
_HESITATION = (
    r"(?:,\s*(?=[uaehmUAEHM])|(?=[uaehmUAEHM])(?<![\p{L}\p{N}'’-]))(?i:uh-huh|mm-hmm|uh-uh|a+h+|e+r+m*|u+m+|u+h+|h+m+|m{2,})(?![\p{L}\p{N}'’-])(?:\.\.\.|…|,)?"
)
_PHRASES = r"(?:you\s+know|sort\s+of|basically|i\s+mean)(?![\p{L}\p{N}'’-])"
_PHRASE = (
    rf",\s*{_PHRASES}(?:\s*(?:\.\.\.|…|,))?|(?<![\p{{L}}\p{{N}}'’-]){_PHRASES}\s*(?:\.\.\.|…|,)"
    rf"|(?<![\p{{L}}\p{{N}}'’-])(?<!\b(?:do|did|if|as) {{1,3}}(?=you))(?<!\b(?:what|any|some|same|this|that) {{1,3}}(?=sort))(?<!\bwhat {{1,3}}(?=i\s)){_PHRASES}"
)
# the first character is looked at before anything else: most places end there
_TIME, _NOTE, _PHRASE = rf"(?=[<\[(@\d])(?:{_TIME})", rf"(?=[\[{{<*(♪♫])(?:{_NOTE})", rf"(?i)(?=[,ysbi])(?:{_PHRASE})"
_NAME = r"(?:(?:Mr|Ms|Mrs|Dr|Prof)\.? )?\p{Lu}[\p{L}'’.-]*(?: \p{Lu}[\p{L}'’.-]*){0,3}"
_SWITCH = rf"(?=[\p{{Lu}}\s.?!…\"”:;])(^\s*|[.?!…\"”:;]\s+|\n\s*)({_NAME})(\s?(?::|\s[-–—])\s+)"
_A, _B = "\x01", "\x02"


def role_class(role: Column) -> Column:
    """management, analyst or moderator for a role in any words; null where it says nothing."""
    r = F.lower(F.trim(role))
    out = F.lit(None).cast("string")
    for k, words in ROLE_WORDS.items():
        out = F.when(r.isin(*words), F.lit(k)).otherwise(out)
    return out


def without_marks(text: Column) -> Column:
    """Text without time marks, annotations and hesitation sounds."""
    t = F.regexp_replace(text, _TIME, " ")
    t = F.regexp_replace(t, _NOTE, " ")
    t = F.regexp_replace(t, _NOTE, " ")  # what was inside another annotation
    return F.regexp_replace(t, _HESITATION, " ")


def tidy(text: Column) -> Column:
    """Filler phrases removed, spaces and punctuation put right."""
    t = F.regexp_replace(text, _PHRASE, " ")
    t = F.regexp_replace(t, r"\s+", " ")
    t = F.regexp_replace(t, r" +([,.?!;:])", "$1")
    t = F.regexp_replace(t, r",(?:\s*,)+", ",")
    return F.trim(F.regexp_replace(t, r"^[\s,;.…-]+(?=[\p{L}\p{N}(])", ""))


def segments(turns: DataFrame) -> DataFrame:
    """One row for each stretch of speech by one label within a row; rows without speech have none."""
    body = F.regexp_replace(without_marks(F.col("text")), _SWITCH, f"$1{_A}$2{_B}$3{_B}")
    parts = F.posexplode(F.split(body, _A)).alias("part", "piece")
    rows = turns.select("call_id", "turn_id", "char_start", "speaker", "role", parts)
    rows = rows.withColumn("inline", F.when(F.instr("piece", _B) > 0, F.substring_index("piece", _B, 1)))
    rows = rows.withColumn("speech", F.when(F.col("inline").isNull(), F.col("piece")).otherwise(F.substring_index("piece", _B, -1)))
    rows = rows.withColumn("plain", F.when(F.col("inline").isNotNull(), F.replace("piece", F.lit(_B), F.lit(""))))
    rows = rows.where(F.col("piece").rlike(r"[\p{L}\p{N}]")).drop("piece")
    return rows.withColumn("speaks", F.col("speech").rlike(r"[\p{L}\p{N}]"))


# --- labels ---------------------------------------------------------------------------------------


def label_words(label: str) -> tuple[str, ...] | None:
    """The words of a label's name; None if it only marks a continuation."""
    s = unicodedata.normalize("NFKC", label).strip()
    s = re.sub(r"[\[(<@]?\s*\b(?:\d{1,2}:\d{2}(?::\d{2})?(?:\.\d+)?|(?:\d{1,2}h)?\d{1,3}m\d{1,2}s)\b\s*[\])>]?", " ", s)
    if re.fullmatch(r"[\W\d_]*", s):
        return None
    plain = " ".join(re.findall(r"[^\W\d_]+", s.casefold()))
    if plain in CONTINUATION:
        return None
    s = re.sub(r"^\s*[\[{<\"'“]+|[\]}>\"'”:]+\s*$", "", s.strip()).strip(" :")
    s = re.sub(r"\s*\([^()]*\)\s*$", "", s)
    s = re.split(r"\s[-–—|/]\s", s)[0]
    if s.count(",") == 1:
        last, first = s.split(",")
        s = f"{first} {last}"
    words = [w for w in re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", s.casefold())]
    while len(words) > 1 and words[0] in TITLES:
        words = words[1:]
    return tuple(words) or None


def edits(a: str, b: str, most: int) -> int:
    """Edits between two strings, a swap of neighbours being one; most + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    older, old = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        older, old = old, row
    return old[-1]


def fits_name(label: tuple[str, ...], name: tuple[str, ...]) -> int:
    """How surely a label names a speaker: 5 same words, 4 other order, 3 initials, 2 a single name, 0 not."""
    if label == name:
        return 5
    if sorted(label) == sorted(name):
        return 4
    first, last = name[0], name[-1]
    if len(name) > 1 and len(label) == 2:
        for a, b in (label, label[::-1]):
            if b == last and len(a) == 1 and first.startswith(a) or a == first and len(b) == 1 and last.startswith(b):
                return 3
    if len(label) == 1 and len(label[0]) > 1 and label[0] in (last, first):
        return 2
    return 0


def fits_spelling(label: tuple[str, ...], name: tuple[str, ...]) -> int:
    """1 if a label is a misspelling of a name, of its initial form or of its last name, else 0."""
    first, last = name[0], name[-1]
    whole, full = " ".join(label), " ".join(name)
    if len(label) == len(name) and len(full) >= 6 and edits(whole, full, 2) <= 2:
        return 1
    if len(label) == 2 == len(name):
        for a, b in (label, label[::-1]):
            if len(a) == 1 and first.startswith(a) and len(last) >= 5 and edits(b, last, 1) == 1 or len(b) == 1 and last.startswith(b) and len(first) >= 5 and edits(a, first, 1) == 1:
                return 1
    if len(label) == 1 and len(label[0]) >= 5 and edits(label[0], last, 1) == 1:
        return 1
    return 0


class Sets:
    """Union-find with path halving; the smaller number is the root."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


class Names:
    """Names by what a label that fits them must share with them, so that a label meets few of them.

    Same words in any order, an initial with a word, and a single word are shared as they are.
    For spelling, a string is cut into five pieces: two edits, each of which touches at most
    two pieces, leave one piece whole, at most two places away.
    """

    PIECES, EDITS = 5, 2

    def __init__(self) -> None:
        self.by: dict[tuple, set[int]] = {}
        self.names: dict[int, tuple[str, ...]] = {}
        self.pieces: dict[tuple[int, int, str], set[int]] = {}
        self.cut: set[int] = set()  # names whose pieces are in the index

    @staticmethod
    def _exact(name: tuple[str, ...], every: bool) -> list[tuple]:
        """Keys of a name; as a member of a cluster (every) in all forms a label may have."""
        keys = [("words", *sorted(name))]
        if len(name) > 1:
            first, last = name[0], name[-1]
            if every:
                keys += [("initial", first[0], last), ("initial", last[0], first), ("one", first), ("one", last)]
            if len(name) == 2:
                keys += [("initial", a, b) for a, b in (name, name[::-1]) if len(a) == 1]
        if len(name) == 1:
            keys.append(("one", name[0]))
        return keys

    @classmethod
    def _pieces(cls, text: str, length: int) -> Iterator[tuple[int, int, str]]:
        """(number, start, length) of the pieces that strings of a length are cut into."""
        at = [length * k // cls.PIECES for k in range(cls.PIECES + 1)]
        for k in range(cls.PIECES):
            yield k, at[k], at[k + 1] - at[k]

    @staticmethod
    def _spelled(name: tuple[str, ...]) -> set[str]:
        """The strings of a name that a misspelling is near to."""
        return {" ".join(name), name[0], name[-1]}

    def add(self, number: int, name: tuple[str, ...]) -> None:
        self.names[number] = name
        for key in self._exact(name, True):
            self.by.setdefault(key, set()).add(number)

    def same(self, name: tuple[str, ...], either: bool = False) -> set[int]:
        """Numbers of the names that this one fits by its words; either: or that fit this one."""
        return set().union(*(self.by.get(key, ()) for key in self._exact(name, either)))

    def spelled(self, name: tuple[str, ...]) -> set[int]:
        """Numbers of the names that this one may be a misspelling of."""
        for number in self.names.keys() - self.cut:  # most names never need this
            for s in self._spelled(self.names[number]):
                for k, a, n in self._pieces(s, len(s)):
                    if n:
                        self.pieces.setdefault((len(s), k, s[a : a + n]), set()).add(number)
            self.cut.add(number)
        out: set[int] = set()
        for s in self._spelled(name):
            for length in range(max(self.PIECES, len(s) - self.EDITS), len(s) + self.EDITS + 1):
                for k, a, n in self._pieces(s, length):
                    for at in range(max(0, a - self.EDITS), a + self.EDITS + 1):
                        out |= self.pieces.get((length, k, s[at : at + n]), set())
        return out


def resolve(labels: list[tuple[str, ...]], people: list[tuple[int, str, str]]) -> list[tuple[str, str, list[int]]]:
    """(kind, canonical name, participants it can be) of each name of a label; kind is 'known' or 'unknown'.

    Nodes of the union-find are the participants and the names. In the first round a name
    meets the participants, in the next ones the names that are in their clusters by then; it
    joins the cluster of what it fits best. One that fits several participants alike stays
    open between them. Names that fit no cluster of a participant cluster among themselves.
    """
    people = sorted((p for p in people if p[1]), key=lambda p: p[0])
    moderators = [i for i, p in enumerate(people) if p[2] == "moderator"]
    nodes = sorted(set(labels))
    names = [label_words(n) or () for _, n, _ in people] + nodes
    at = {w: len(people) + i for i, w in enumerate(nodes)}
    sets = Sets(len(names))
    open_: dict[tuple[str, ...], list[int]] = {}

    index = Names()
    for i, n in enumerate(names[: len(people)]):
        if n:
            index.add(i, n)
    waiting = []
    for w in nodes:
        if " ".join(w) in MODERATOR_LABELS and moderators:
            open_[w] = moderators
            if len(moderators) == 1:
                sets.join(moderators[0], at[w])
        else:
            waiting.append(w)
    joined: list[tuple[str, ...]] = []
    while waiting:
        found, rest = [], []
        for w in waiting:
            scores = {i: fits_name(w, names[i]) for i in index.same(w)}
            best = max(scores.values(), default=0)
            if not best:
                scores = {i: fits_spelling(w, names[i]) for i in index.spelled(w)}
                best = max(scores.values(), default=0)
            who = sorted({sets.find(i) for i, s in scores.items() if s == best and best})
            if who:
                open_[w] = who
                if len(who) == 1:
                    found.append((who[0], w))
            else:
                rest.append(w)
        for i, w in found:
            sets.join(i, at[w])
        waiting, joined = rest, [w for _, w in found]
        if not joined:
            break
        index = Names()  # who fits a participant has met it: the next round is for what is near to its variants
        for w in joined:
            index.add(at[w], w)
    strangers = Names()
    for w in waiting:
        for i in strangers.same(w, True) | strangers.spelled(w):
            a, b = w, names[i]
            if fits_name(a, b) or fits_name(b, a) or fits_spelling(a, b):
                sets.join(i, at[w])
        strangers.add(at[w], w)
    out = []
    for w in labels:
        if w in open_:
            out.append(("known", people[open_[w][0]][1] if len(open_[w]) == 1 else " ".join(w), [people[i][0] for i in open_[w]]))
        else:
            out.append(("unknown", " ".join(names[sets.find(at[w])]), []))
    return out


def names_of(labels: DataFrame) -> DataFrame:
    """(l_call, label, name) of distinct (call_id, label): the words of the label's name, null if it only marks a continuation."""
    kind_of_call = labels.schema["call_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [" ".join(w) if (w := label_words(x)) else None for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string())], ["l_call", "label", "name"])

    return labels.select("call_id", "label").mapInArrow(run, f"l_call {kind_of_call}, label string, name string")


def label_table(labels: DataFrame, participants: DataFrame) -> DataFrame:
    """(l_call, label, kind, canonical, fits) of distinct (call_id, label); kind is 'same', 'known' or 'unknown', fits an array of participants (id, name, role).

    What is gathered for a call is its roster and the different names in its labels.
    """
    named = cut(names_of(labels))  # read for the calls and for the labels
    by_call = named.where("name is not null").groupBy(F.col("l_call").alias("call_id")).agg(F.collect_set("name").alias("names"))
    people = participants.groupBy(F.col("call_id").alias("p_call")).agg(F.collect_list(F.struct(F.col("participant_id").alias("id"), F.col("name").alias("name"), F.col("role").alias("role"))).alias("people"))
    rows = merge_join(by_call, people, F.col("call_id").eqNullSafe(F.col("p_call")), "left").select("call_id", "names", "people")
    kind_of_call = rows.schema["call_id"].dataType.simpleString()
    person = pa.struct([("id", pa.int64()), ("name", pa.string()), ("role", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            calls, name, kind, canonical, fits = [], [], [], [], []
            for i, (own, people) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                roster = {p["id"]: p for p in people or () if p["id"] is not None}
                found = resolve([tuple(n.split(" ")) for n in own], [(k, p["name"], (p["role"] or "").lower()) for k, p in roster.items()])
                for x, (k, c, ids) in zip(own, found):
                    calls.append(i)
                    name.append(x)
                    kind.append(k)
                    canonical.append(c)
                    fits.append([roster[j] for j in ids])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(calls, pa.int64())), pa.array(name, pa.string()), pa.array(kind, pa.string()), pa.array(canonical, pa.string()), pa.array(fits, pa.list_(person))],
                ["n_call", "n_name", "kind", "canonical", "fits"],
            )

    table = rows.mapInArrow(run, f"n_call {kind_of_call}, n_name string, kind string, canonical string, fits array<struct<id:bigint,name:string,role:string>>")
    out = merge_join(named, table, F.col("l_call").eqNullSafe(F.col("n_call")) & (F.col("name") == F.col("n_name")), "left")
    return out.select("l_call", "label", F.coalesce("kind", F.lit("same")).alias("kind"), "canonical", "fits")


# --- turns ----------------------------------------------------------------------------------------


def clean_turns(turns: DataFrame, participants: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(call_id, turn_no, first_turn_id, last_turn_id, participant_id, speaker, role, text) of every clean turn.

    speaker is the participant's name, or for one who is on no roster the canonical name of its
    labels. Where the texts aren't asked for, they stay out of the shuffles.
    """
    # cleaned once, and read for the labels and for the rows
    parts = cut(segments(turns.select("call_id", "turn_id", "char_start", "speaker", "role", "text")))
    labels = parts.select("call_id", F.explode(F.array("speaker", "inline")).alias("label")).where("label is not null").distinct()
    known = cut(label_table(labels, participants))  # read by both joins below
    who = F.struct("kind", "canonical", "fits")

    # few rows name a speaker inside the text; the others skip this join. A name there that is no participant is part of the text
    within = known.where("kind = 'known'").select(F.col("l_call").alias("c"), F.col("label").alias("l"), F.col("fits").alias("within"))
    named = merge_join(parts.where("inline is not null"), within, F.col("call_id").eqNullSafe(F.col("c")) & (F.col("inline") == F.col("l")), "left").drop("c", "l")
    named = named.withColumns({"speech": F.when(F.col("within").isNotNull(), F.col("speech")).otherwise(F.col("plain")), "speaks": F.col("speaks") | F.col("within").isNull()})
    rows = parts.where("inline is null").withColumn("within", F.lit(None).cast(named.schema["within"].dataType)).unionByName(named).where("speaks")
    own = known.select(F.col("l_call").alias("c"), F.col("label").alias("l"), who.alias("own"))
    rows = merge_join(rows, own, F.col("call_id").eqNullSafe(F.col("c")) & (F.col("speaker") == F.col("l")), "left").drop("c", "l")

    role = role_class(F.col("role"))
    same_role = F.filter(F.col("own.fits"), lambda f: F.lower(f["role"]) == role)
    fits = F.when(F.size(same_role) > 0, same_role).otherwise(F.col("own.fits"))
    stranger = F.struct(F.lit(None).cast("bigint").alias("id"), F.col("own.canonical").alias("name"), F.lit(None).cast("string").alias("role"))
    rows = rows.select(
        "call_id", "turn_id", "part", "speech",
        F.when(F.col("own.kind") == "known", F.array_min(fits)).when(F.col("own.kind") == "unknown", stranger).alias("own"),
        F.when(F.col("within").isNotNull(), F.struct(F.col("turn_id").alias("turn_id"), F.array_min("within").alias("who"))).alias("switch"),
        F.coalesce(F.col("char_start").cast("bigint"), F.lit((1 << 62) - 1)).alias("pos"), F.col("char_start").isNull().alias("alone"),
    )
    rows = rows.withColumn("block", F.floor(F.col("pos") / F.lit(block_chars)).cast("bigint"))
    # all windows below use one partitioning and one order
    order = Window.partitionBy("call_id", "block").orderBy("pos", "turn_id", "part")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    begins = F.col("alone") | ~F.col("pos").eqNullSafe(F.lag("pos").over(order))
    rows = rows.withColumn("delivered", F.when(begins, F.col("turn_id")))
    rows = rows.withColumn("delivered", F.last("delivered", True).over(upto)).where("turn_id <=> delivered").drop("delivered", "alone")
    # a name inside a row holds for the rest of the row, the row's own label before it
    rows = rows.withColumn("switch", F.last("switch", True).over(upto))
    rows = rows.withColumn("here", F.when(F.col("switch.turn_id") == F.col("turn_id"), F.col("switch.who")).otherwise(F.col("own"))).drop("own", "switch")
    rows = rows.withColumn("here", F.last("here", True).over(upto))
    rows = rows.withColumn("before", F.lag("here").over(order))
    rows = rows.withColumn("changes", F.sum(F.coalesce((F.col("here") != F.col("before")).cast("int"), F.lit(0))).over(upto)).drop("before")

    place = F.struct("pos", "turn_id", "part")
    blocks = rows.groupBy(F.col("call_id").alias("b_call"), F.col("block").alias("b")).agg(
        F.min_by("here", F.when(F.col("here").isNotNull(), place)).alias("first"), F.max_by("here", place).alias("last"), F.max("changes").alias("n")
    )
    over_blocks = Window.partitionBy("b_call").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("carried", F.last("last", True).over(over_blocks))
    blocks = blocks.withColumn("new", (F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("carried"))).cast("int"))
    blocks = blocks.withColumn("earlier", F.coalesce(F.sum(F.col("n") + F.col("new")).over(over_blocks), F.lit(0)))
    rows = merge_join(rows, blocks.select("b_call", "b", "carried", "new", "earlier"), F.col("call_id").eqNullSafe(F.col("b_call")) & (F.col("block") == F.col("b")))
    turn_no = F.col("earlier") + F.when(F.col("here").isNotNull(), F.col("new") + F.col("changes")).otherwise(F.lit(0))
    rows = rows.select("call_id", turn_no.alias("turn_no"), F.coalesce("here", "carried").alias("who"), "pos", "turn_id", "part", "speech")

    out = rows.groupBy("call_id", "turn_no").agg(
        F.min_by("turn_id", place).alias("first_turn_id"),
        F.max_by("turn_id", place).alias("last_turn_id"),
        F.first("who").alias("who"),
        F.array_sort(F.collect_list(F.struct("pos", "turn_id", "part", tidy(F.col("speech")).alias("text")))).alias("said"),
    )
    return out.select("call_id", "turn_no", "first_turn_id", "last_turn_id", F.col("who.id").alias("participant_id"), F.col("who.name").alias("speaker"), F.col("who.role").alias("role"), F.array_join(F.col("said.text"), " ").alias("text"))
