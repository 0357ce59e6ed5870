"""Chat formatting: turns to marked text segments with loss flags, and reading them back.

A template says which control strings open and close a role's turn, which roles' texts are under the loss mask,
and which role may follow in which state. A finite-state machine over the roles checks the order of turns. Control
strings inside texts are escaped, so those of the output are the template's own and every conversation can be read
back. All of it is DataFrame functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.llm.common import table
from lanelux.session import settle

ESCAPE = "\\"
#: The state of a conversation whose turns are out of order; no move leads out of it.
REJECT = "reject"


@dataclass(frozen=True)
class Turn:
    """Control strings before and behind a role's text; ``loss`` puts the text under the loss mask."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """How turns are written and which orders are valid.

    ``other`` marks turns of all roles not named; there the role stands between its ``open`` and ``says``.
    ``moves`` has the next state for a state and a role; all else leads to ``REJECT``. A conversation is complete
    if it ends in one of ``ends``.

    A control string begins with one of ``openers`` and holds no other opener and no escape, and none is the
    beginning of another. So one control string in a text ends before the next begins, and none arises where
    a text meets a mark.
    """

    roles: dict[str, Turn]
    other: Turn
    says: str
    moves: dict[tuple[str, str], str]
    start: str = "start"
    ends: tuple[str, ...] = ("assistant",)
    openers: str = "<["

    def __post_init__(self) -> None:
        opens = [t.open for t in self._turns]
        if len(set(opens)) < len(opens) or set(opens) & ({t.close for t in self._turns} | {self.says}):
            raise ValueError("each role needs an opening mark of its own")
        for c in self.controls:
            if len(c) < 2 or c[0] not in self.openers or any(x in c[1:] for x in (*self.openers, ESCAPE)):
                raise ValueError(f"not a control string: {c!r}")
            if any(d != c and d.startswith(c) for d in self.controls):
                raise ValueError(f"{c!r} is the beginning of another control string")

    @property
    def _turns(self) -> list[Turn]:
        return [*self.roles.values(), self.other]

    @property
    def controls(self) -> list[str]:
        return sorted({t.open for t in self._turns} | {t.close for t in self._turns} | {self.says})

    @property
    def pattern(self) -> str:
        """Any control string."""
        return "|".join(re.escape(c) for c in self.controls)

    @property
    def _rest(self) -> str:
        return "|".join(sorted({re.escape(c[1:]) for c in self.controls}))

    def escape(self, text: Column) -> Column:
        """An escape more between an opener and what makes it a control string, however many there are already."""
        return F.regexp_replace(text, rf"([{re.escape(self.openers)}])(\\*)({self._rest})", r"$1\\$2$3")

    def unescape(self, text: Column) -> Column:
        """An escape fewer at each such place."""
        return F.regexp_replace(text, rf"([{re.escape(self.openers)}])\\(\\*)({self._rest})", "$1$2$3")

    def segments(self, role: Column, text: Column) -> Column:
        """A turn as segments (text, loss): marks, and the text with its role's flag."""

        def segment(part: Column, loss: bool = False) -> Column:
            return F.struct(part.alias("text"), F.lit(loss).alias("loss"))

        def written(turn: Turn, *before: Column) -> Column:
            own = (segment(self.escape(text), turn.loss), segment(F.lit(turn.close)))
            return F.array(segment(F.lit(turn.open)), *before, *own)

        out = written(self.other, segment(self.escape(role)), segment(F.lit(self.says)))
        for name, turn in self.roles.items():
            out = F.when(role == name, written(turn)).otherwise(out)
        return out

    def order(self, roles: Column) -> Column:
        """The machine's state behind the last role, and how many turns it took before it rejected one."""
        moves = F.create_map(*[F.lit(x) for (state, role), to in self.moves.items() for x in (f"{state}\n{role}", to)])

        def move(now: Column, role: Column) -> Column:
            to = F.coalesce(F.try_element_at(moves, F.concat(now["state"], F.lit("\n"), role)), F.lit(REJECT))
            return F.struct(to.alias("state"), (now["taken"] + (to != REJECT).cast("int")).alias("taken"))

        return F.aggregate(roles, F.struct(F.lit(self.start).alias("state"), F.lit(0).alias("taken")), move)


#: A system turn may come first; users and assistants take turns, the user first.
PLAIN = Template(
    roles={
        "system": Turn("[SYS]", "[/SYS]"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    },
    other=Turn("[ROLE]", "[/ROLE]"),
    says="[SAYS]",
    moves={
        ("start", "system"): "system",
        ("start", "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    },
)


def format_chats(turns: DataFrame, template: Template = PLAIN) -> DataFrame:
    """Each conversation of ``turns`` (conv_id, turn, role, text) as one row: conv_id, segments, state, n_taken, complete.

    ``segments`` (text, loss) one after another are the formatted conversation. ``state`` is the machine's last,
    ``n_taken`` the turns it took before one was out of order; such conversations are formatted all the same.
    Turns go by turn, equal ones by role and text, null ones first; repeated rows are turns of their own. A null
    text or role is the empty one, a role that the template does not name is written out. A row without
    conv_id is a conversation of its own, so those rows never gather. An empty table gives no rows.
    Other columns are not read. A conversation is one value, so it must fit into one (2 GB of text).
    """
    rows = turns.select(
        "conv_id",
        F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("_lone"),
        F.struct(
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("_turn"),
    )
    ordered = rows.groupBy("conv_id", "_lone").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    segments = F.flatten(F.transform("_turns", lambda t: template.segments(t["role"], t["text"])))
    order = template.order(F.transform("_turns", lambda t: t["role"]))
    formed = ordered.select("conv_id", segments.alias("segments"), order.alias("_order"))
    state = F.col("_order.state")
    return formed.select(
        "conv_id", "segments", state.alias("state"), F.col("_order.taken").cast("long").alias("n_taken"),
        state.isin(*template.ends).alias("complete"),
    )


def read_chats(chats: DataFrame, template: Template = PLAIN) -> DataFrame:
    """``chats`` with ``formatted``, the ``turns`` (role, text) found in it by its marks, and ``loss_texts``.

    ``loss_texts`` are the unescaped texts of the segments under the loss mask.
    """
    whole = chats.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    marks = F.regexp_extract_all("formatted", F.lit(template.pattern), F.lit(0))
    pieces = F.split("formatted", template.pattern, -1)
    behind = [F.slice(pieces, at, F.size(pieces)) for at in (2, 3)]
    zipped = F.arrays_zip(marks.alias("mark"), behind[0].alias("first"), behind[1].alias("second"))

    def turn(z: Column) -> Column:
        other = z["mark"] == template.other.open
        role = F.when(other, template.unescape(z["first"]))
        for name, own in template.roles.items():
            role = F.when(z["mark"] == own.open, name).otherwise(role)
        text = template.unescape(F.when(other, z["second"]).otherwise(z["first"]))
        return F.struct(role.alias("role"), text.alias("text"))

    turns = F.filter(F.transform(zipped, turn), lambda t: t["role"].isNotNull())
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: template.unescape(s["text"]))
    return whole.withColumns({"turns": turns, "loss_texts": loss})


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds control strings, formatted, stored, and read back."""
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    read = read_chats(settle(format_chats(own.unionByName(hard)), "chats"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "state",
        "n_taken",
        "complete",
    )


OP13_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, regexp_replace(text,
    '([<\[])(\\*)(s>|/s>|SYS\]|/SYS\]|INST\]|/INST\]|ROLE\]|/ROLE\]|SAYS\])', '\1\\\2\3', 'g') AS inner_text,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM said),
judged AS (
  SELECT *, CASE role
      WHEN 'system' THEN before IS NULL
      WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
      WHEN 'assistant' THEN before IS NOT NULL AND before = 'user'
      ELSE false END AS fits,
    CASE role
      WHEN 'system' THEN '[SYS]' || inner_text || '[/SYS]'
      WHEN 'user' THEN '[INST]' || inner_text || '[/INST]'
      WHEN 'assistant' THEN '<s>' || inner_text || '</s>'
      ELSE '[ROLE]' || role || '[SAYS]' || inner_text || '[/ROLE]' END AS piece,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place
  FROM marked),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS all_turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY place), '') AS all_loss,
    string_agg(piece, '' ORDER BY place) AS formatted,
    min(CASE WHEN NOT fits THEN place END) AS wrong,
    arg_max(role, place) AS last_role
  FROM judged GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(all_turns) AS turns_sha256, CAST(length(all_loss) AS BIGINT) AS loss_chars,
  sha256(all_loss) AS loss_sha256, CAST(length(formatted) AS BIGINT) AS formatted_chars,
  CASE WHEN wrong IS NULL THEN last_role ELSE 'reject' END AS state,
  coalesce(wrong - 1, n_turns) AS n_taken,
  wrong IS NULL AND last_role = 'assistant' AS complete
FROM joined
"""
