"""Chat transcripts to canonical turns.

A transcript is lines. A hidden Markov model has a state for each role at the first line of a turn and inside one;
it sees, for each line, what speaker marker it starts with, its length, whether it asks, and what is before it.
Viterbi recovers the states, hence the turns and their roles, also where markers are missing or mixed; then markers
are taken off and each turn is rendered in one form.

Counts for the model are summed over all labelled transcripts that aren't held out. A long transcript comes in parts
of bounded length: each part gives the best score from every state before it to every state at its end, parts are
chained by these small matrices, and each part is then decoded between its two states. The result is that of one
Viterbi run over the whole transcript, without any task having to hold it.

Defined results: rows with a null id are left out; a null text is an empty one; a transcript without any non-blank
line gives no turn; rows of a turn table that repeat (id, turn, text) count once, and turns of an equal number are in
order of their text; a null turn number is before all; a part without any non-blank line takes no part in the chain;
a role other than the three teaches nothing, and its turns get the likeliest of the three; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, named, written

ROLES = ("system", "user", "assistant")
N_STATES = 2 * len(ROLES)  # 2 * role: first line of a turn; 2 * role + 1: a further line

#: Words that stand for a role as a speaker marker.
MARKERS = {
    "system": ("system", "sys", "instruction", "instructions", "context"),
    "user": ("user", "human", "question", "q", "prompter", "customer", "client", "me", "usuario", "utilisateur", "nutzer"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "model", "agent", "gpt", "asistente", "assistent"),
}
#: Values of each feature: marker (none, a role's, unknown), length, asks, what is before.
SIZES = (len(ROLES) + 2, 4, 2, 3)


#: What is not white space to str.strip().
SOLID = r"[^\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _tools():
    import re

    role_of = {w: r for r, words in enumerate(MARKERS.values()) for w in words}
    marker = re.compile(r"^(?:[#>*\-\s]{0,6})(?:(?P<open>[\[(<])(?P<a>[^\W\d_]{1,12})[\])>]:?|\**(?P<b>[^\W\d_]{1,12})\**\s?(?::|>+))\s*")
    return role_of, marker


def split_marker(line: str) -> tuple[int, str]:
    """(0: none, 1 + role, or one more for an unknown speaker; the line without it)."""
    role_of, marker = _tools_kept()
    m = marker.match(line)
    if not m:
        return 0, line
    role = role_of.get((m["a"] or m["b"]).lower())
    if role is None:
        return (0, line) if m["open"] else (len(ROLES) + 1, line)
    return 1 + role, line[m.end() :]


def _tools_kept():
    from .common import kept_in_worker

    return kept_in_worker("chat-tools", _tools)


def observed(lines: list[str], start_of_all: bool):
    """A row of feature values for each non-blank line, and the lines' places. Parts are cut at blank lines."""
    import numpy as np

    rows, places, gap = [], [], 2 if start_of_all else 1
    for i, line in enumerate(lines):
        if not line.strip():
            gap = max(gap, 1)
            continue
        n = len(line)
        rows.append((split_marker(line)[0], (n > 40) + (n > 100) + (n > 250), int(line.rstrip().endswith("?")), gap))
        places.append(i)
        gap = 0
    return np.array(rows, np.int64).reshape(-1, len(SIZES)), places


def transcripts(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part_turns: int = 256) -> DataFrame:
    """(id, part, text, labels): turn tables written as raw transcripts, to parse or to learn from.

    Each conversation has one of six marker styles by a hash of its id, and a fifth of the turns lack a marker. A
    blank line stands between turns. labels: the role of each line's turn and whether the line is its first.
    """
    own = conversations.select(named(id_col).cast("long").alias("id"), named(turn_col).cast("long").alias("turn"), F.lower(named(role_col).cast("string")).alias("role"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("body"))
    own = own.where("id is not null").groupBy("id", "turn", "role", "body").agg(F.count(F.lit(1)).alias("copies"))
    style = F.pmod(F.xxhash64("id"), F.lit(6))
    shown = F.initcap("role")
    qa = F.when(F.col("role") == "user", "Q").when(F.col("role") == "assistant", "A").otherwise(shown)
    human = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise(shown)
    marker = F.when(style == 0, F.concat(shown, F.lit(": "))).when(style == 1, F.concat(F.lit("### "), human, F.lit(": "))).when(style == 2, F.concat(qa, F.lit(": "))).when(style == 3, F.concat(F.lit("["), "role", F.lit("] "))).when(style == 4, F.concat(F.lit("**"), shown, F.lit("**: "))).otherwise("")
    marker = F.when(F.pmod(F.xxhash64("id", "turn"), F.lit(5)) == 0, "").otherwise(F.coalesce(marker, F.lit("")))
    part = F.floor(F.coalesce("turn", F.lit(-1)) / part_turns).cast("long")
    turns = own.select("id", part.alias("part"), F.struct(F.coalesce("turn", F.lit(-(1 << 62))).alias("turn"), "body", "role", F.concat(marker, "body").alias("text")).alias("t"))
    parts = turns.groupBy("id", "part").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return parts.select("id", "part", F.array_join(F.transform("ts", lambda t: t["text"]), "\n\n").alias("text"), F.transform("ts", lambda t: F.struct(t["role"].alias("role"), (F.size(F.split(t["text"], "\n")) + 1).alias("lines"))).alias("labels"))


def _sums(batches: Iterator) -> Iterator:
    """(cell, count): transitions and features by state, of labelled parts."""
    import numpy as np
    import pyarrow as pa

    start, move, seen = np.zeros(N_STATES), np.zeros((N_STATES, N_STATES)), [np.zeros((N_STATES, n)) for n in SIZES]
    for batch in batches:
        for part, text, labels in zip(*(batch.column(i).to_pylist() for i in range(3))):
            lines = (text or "").split("\n")
            roles = [(k, x["role"]) for k, x in enumerate(labels or []) for _ in range(x["lines"])]
            rows, places = observed(lines, part <= 0)
            states, last = [], None
            for i in places:
                turn, role = roles[i] if i < len(roles) else (None, None)
                states.append(2 * ROLES.index(role) + (turn == last) if role in ROLES else -1)
                last = turn
            for i, s in enumerate(states):
                if s >= 0:
                    for f, table in enumerate(seen):
                        table[s, rows[i, f]] += 1
                    if i == 0 and part <= 0:
                        start[s] += 1
                    elif i and states[i - 1] >= 0:
                        move[states[i - 1], s] += 1
    flat = np.concatenate([start, move.ravel(), *(t.ravel() for t in seen)])
    yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["cell", "count"])


def fit(labelled: DataFrame):
    """(start, move, seen): log probabilities, smoothed, from the counts over all labelled parts."""
    import numpy as np

    sizes = [N_STATES, N_STATES * N_STATES, *(N_STATES * n for n in SIZES)]
    counts = np.zeros(sum(sizes))
    for r in map_batches(labelled.select("part", "text", "labels"), _sums, "cell int, count double").groupBy("cell").agg(F.sum("count").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    start, move, *seen = np.split(counts, np.cumsum(sizes)[:-1])
    log = lambda a, by: np.log((a + by) / (a + by).sum(axis=-1, keepdims=True))
    allowed = np.zeros((N_STATES, N_STATES))
    for a in range(N_STATES):
        for b in range(N_STATES):
            # a further line belongs to the turn before it
            allowed[a, b] = 0 if b % 2 == 0 or a // 2 == b // 2 else -1e9
    first = np.where(np.arange(N_STATES) % 2 == 0, 0, -1e9)
    return log(start, 0.1) + first, log(move.reshape(N_STATES, N_STATES), 0.1) + allowed, [log(t.reshape(N_STATES, -1), 0.5) for t in seen]


def _emissions(rows, model):
    return sum(table[:, rows[:, f]].T for f, table in enumerate(model[2]))


def _chain(rows, model):
    """scores[a, b]: the best from state a before the part to state b at its end."""
    import numpy as np

    best = np.where(np.eye(N_STATES, dtype=bool), 0.0, -1e18)
    for e in _emissions(rows, model):
        best = (best[:, :, None] + model[1][None]).max(axis=1) + e
    return best


def viterbi(rows, model, before: int | None = None, at_end: int | None = None) -> list[int]:
    """The likeliest states; before: the state of the line before, none at the start of a transcript."""
    import numpy as np

    start, move, _ = model
    emitted = _emissions(rows, model)
    score, back = (start if before is None else move[before]) + emitted[0], []
    for e in emitted[1:]:
        step = score[:, None] + move
        back.append(step.argmax(axis=0))
        score = step.max(axis=0) + e
    path = [int(score.argmax()) if at_end is None else at_end]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def parse(parts: DataFrame, model) -> DataFrame:
    """(id, part, turn, role, content, continued) from parts (id, part, text) of transcripts.

    turn counts within the part, from 0; continued: the turn goes on from the part before.
    """
    held = written(parts.select(F.col("id").cast("long").alias("id"), F.col("part").cast("long").alias("part"), F.col("text").cast("string").alias("text")).where("id is not null").where(F.rlike("text", F.lit(SOLID))), "chat-parts")
    starts = held.groupBy("id").agg(F.min("part").alias("first"), F.count(F.lit(1)).alias("n_parts"))
    joined = held.join(starts, "id")
    long = joined.where("n_parts > 1")

    def chained(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for part, first, text in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                rows, _ = observed((text or "").split("\n"), part == first)
                out.append(_chain(rows, model).ravel().tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))], ["id", "part", "scores"])

    def resolved(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for key, own in zip(*(batch.column(i).to_pylist() for i in range(2))):
                own = sorted(own, key=lambda x: x["part"])
                score, back = None, []
                for x in own:
                    if score is None:  # from the start: the first line's move is the start itself
                        score = np.array(x["from_start"])
                        continue
                    step = score[:, None] + np.array(x["scores"]).reshape(N_STATES, N_STATES)
                    back.append(step.argmax(axis=0))
                    score = step.max(axis=0)
                ends = [int(score.argmax())]
                for b in reversed(back):
                    ends.append(int(b[ends[-1]]))
                ends = ends[::-1]
                out += [(key, x["part"], ends[i - 1] if i else -1, ends[i]) for i, x in enumerate(own)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["id", "part", "before", "at_end"])

    def started(batches: Iterator) -> Iterator:
        """The best score from the start to each state at the end of a first part."""
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for text in batch.column(3).to_pylist():
                rows, _ = observed((text or "").split("\n"), True)
                score = model[0]
                for i, e in enumerate(_emissions(rows, model)):
                    score = (score if i == 0 else (score[:, None] + model[1]).max(axis=0)) + e
                out.append(np.asarray(score).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))], ["id", "part", "from_start"])

    cols = long.select("id", "part", "first", "text")
    scores = map_batches(cols.where("part > first"), chained, "id long, part long, scores array<double>").withColumn("from_start", F.lit(None).cast("array<double>"))
    scores = scores.unionByName(map_batches(cols.where("part = first"), started, "id long, part long, from_start array<double>").withColumn("scores", F.lit(None).cast("array<double>")))
    ends = map_batches(scores.groupBy("id").agg(F.collect_list(F.struct("part", "scores", "from_start")).alias("own")), resolved, "id long, part long, before int, at_end int")

    def decoded(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for key, part, first, text, before, at_end in zip(*(batch.column(i).to_pylist() for i in range(6))):
                lines = (text or "").split("\n")
                rows, places = observed(lines, part == first)
                if not places:
                    continue
                states = viterbi(rows, model, None if before is None or before < 0 else before, at_end)
                turns = []
                for n, (i, s) in enumerate(zip(places, states)):
                    if s % 2 == 0 or not turns:
                        turns.append([s // 2, s % 2 == 1, [split_marker(lines[i])[1] if s % 2 == 0 else lines[i]], i])
                    else:
                        turns[-1][2] += [""] * (i - turns[-1][3] - 1) + [lines[i]]
                        turns[-1][3] = i
                out += [(key, part, k, ROLES[r], "\n".join(own).strip(), c) for k, (r, c, own, _) in enumerate(turns)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, kinds)], ["id", "part", "turn", "role", "content", "continued"])

    ready = joined.join(ends, ["id", "part"], "left").select("id", "part", "first", "text", "before", "at_end")
    return map_batches(ready, decoded, "id long, part long, turn int, role string, content string, continued boolean")


def rendered(role: str | Column, content: str | Column) -> Column:
    """One turn in canonical form; what looks like its delimiters inside the content is escaped."""
    body = F.regexp_replace(content, r"<\|", r"<\\\\|")
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), body, F.lit("\n<|end|>\n"))


def held_out(key: Column) -> Column:
    """Whether a conversation is kept from training."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def format_chats(conversations: DataFrame, **columns: str) -> DataFrame:
    """(id, part, turn, role, content, continued, rendered) recovered from the transcripts of a turn table."""
    raw = written(transcripts(conversations, **columns), "chat-raw")
    model = fit(raw.where(~held_out(F.col("id"))))
    turns = parse(raw, model)
    return turns.withColumn("rendered", rendered("role", "content"))
