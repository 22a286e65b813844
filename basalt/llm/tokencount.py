"""Token counts by a finite-state transducer compiled from a BPE vocabulary of pieces."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.llm.common import kept

#: The mark that stands for a space within pieces.
SPACE = "▁"
#: Characters of a chunk; the chunks of a longer text are mapped apart and their maps composed.
CHUNK = 65_536
#: States, characters of words, and pairs of tokens, that a worker keeps before it starts anew.
MAX_STATES, MAX_CHARS, MAX_PAIRS = 400_000, 36_000_000, 600_000
#: Tokens above which a text is over the limit.
LIMIT = 4096


def read_pieces(path: str) -> dict[str, float]:
    """Scores of the normal pieces of a SentencePiece BPE model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores = {}
    for i in range(model.vocab_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            scores[model.id_to_piece(i)] = model.get_score(i)
    return scores


def last_merge(token: str, scores: dict[str, float]) -> tuple[str, str] | None:
    """The two tokens whose merge, the last of plain BPE, makes ``token``; None if BPE of its
    characters does not end in it. Best score first, leftmost on ties."""
    symbols, last = list(token), ("", token)
    while len(symbols) > 1:
        best = max(((scores[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in scores), default=None)
        if best is None:
            return None
        i = -best[1]
        last = symbols[i], symbols[i + 1]
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
    return last


class Transducer:
    """A deterministic transducer over characters whose transitions carry token counts.

    After every prefix of a word, BPE leaves one last token; a longer word's tokens are those of
    a prefix followed by one token, and a token may follow another if BPE leaves the two alone.
    A state therefore needs only the longest suffix that may still grow into a piece, and for
    the start of that suffix and every place in it the last token there and the tokens counted.
    Equal states are one, so the machine is finite; its transitions are compiled when first
    taken and say by how much the count of tokens changes. White space leads back to the start,
    as no piece continues past it.
    """

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.prefixes = {piece[:n] for piece in scores for n in range(1, len(piece) + 1)}
        self.together: dict[tuple[str, str], bool] = {}
        self.spines: dict[tuple[str, int], list[str] | None] = {}
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        self.start = self.number("", ((0, "", 0, False),))

    def number(self, suffix: str, places: tuple) -> int:
        """The state's number. A place is (offset in the suffix, last token there, count relative
        to the end, whether the word's first token is a lone space mark); "" stands at a word's
        start, None after a character that nothing merges with. Only places from which a piece
        may still grow are kept, and the end."""
        found = self.numbers.get((suffix, places))
        if found is None:
            found = self.numbers[suffix, places] = len(self.keys)
            self.keys.append((suffix, places))
            self.moves.append({})
        return found

    def spine(self, token: str, side: int) -> list[str] | None:
        """The symbols that stand at the token's end (side 1) or start (side 0) while BPE builds
        it, from its character on; None if BPE does not build it."""
        known = self.spines.get((token, side), False)
        if known is not False:
            return known
        parts = last_merge(token, self.scores)
        found = None if parts is None else [token] if len(token) == 1 else [*(self.spine(parts[side], side) or [parts[side]]), token]
        self.spines[token, side] = found
        return found

    def allowed(self, first: str | None, second: str) -> bool:
        """Whether BPE of the two tokens' text gives just these two: as both are built, nothing
        may merge across the border before both are done, nor then."""
        right = self.spine(second, 0)
        if right is None or not first:
            return right is not None
        known = self.together.get((first, second))
        if known is None:
            left, scores, i, j = self.spine(first, 1), self.scores, 0, 0
            known = True
            while True:
                across = scores.get(left[i] + right[j])
                one = scores[left[i + 1]] if i + 1 < len(left) else None
                two = scores[right[j + 1]] if j + 1 < len(right) else None
                if across is not None and (one is None or across > one) and (two is None or across >= two):
                    known = False
                    break
                if one is None and two is None:
                    break
                if two is None or (one is not None and one >= two):
                    i += 1
                else:
                    j += 1
            if len(self.together) > MAX_PAIRS:
                self.together.clear()
            self.together[first, second] = known
        return known

    def compile(self, at: int, char: str) -> tuple[int, int]:
        """The transition (state after ``char``, change of the count), made and kept."""
        suffix, places = self.keys[at]
        scores, prefixes = self.scores, self.prefixes
        if char not in scores:
            moved = self.number("", ((0, None, 0, places[-1][3]),)), len(char.encode())
        else:
            whole, together = suffix + char, self.together
            for offset, last, count, lone in places:
                token = whole[offset:]
                if token not in scores:
                    continue
                fits = together.get((last, token))
                if self.allowed(last, token) if fits is None else fits:
                    total, first_lone = count + 1, token == SPACE if last == "" else lone
                    break
            live = [x for x in places if whole[x[0] :] in prefixes]
            keep = live[0][0] if live else len(whole)
            kept = (*((o - keep, t, n - total, x) for o, t, n, x in live), (len(whole) - keep, token, 0, first_lone))
            moved = self.number(whole[keep:], kept), total - places[-1][2]
        self.moves[at][char] = moved
        return moved

    def run_sorted(self, words: list[str]) -> Iterator[tuple[int, bool]]:
        """Of each word, its space mark first, the tokens and whether that mark is a token alone.
        Words come in order, so each is walked only from where it leaves the one before."""
        path, before = [(self.start, 0)], ""
        for word in words:
            if len(self.keys) > MAX_STATES:
                self.reset()
                path, before = [(self.start, 0)], ""
            same = 0
            for x, y in zip(word, before):
                if x != y:
                    break
                same += 1
            del path[same + 1 :]
            at, count = path[-1]
            moves = self.moves
            for char in word[same:]:
                moved = moves[at].get(char) or self.compile(at, char)
                at = moved[0]
                count += moved[1]
                path.append((at, count))
            before = word
            yield count, self.keys[at][1][-1][3]


class Counter:
    """Counts the tokens of texts: maps chunks, and composes the maps."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.machine = Transducer(scores)
        self.longest = max(n for n in range(1, 65) if SPACE * n in scores)
        self.reset()

    def reset(self) -> None:
        self.counts: dict[str, int] = {}
        self.lone: set[str] = set()
        self.held = 0

    def learn(self, words: set[str]) -> None:
        """Count the tokens of words that are not remembered."""
        counts = self.counts
        new = sorted(x for x in words if x and x not in counts)
        if not new:
            return
        size = sum(map(len, new))
        if self.held + size > MAX_CHARS and self.counts:
            self.reset()
            new = sorted(words - {""})
            size = sum(map(len, new))
        self.held += size
        for word, (count, lone) in zip(new, self.machine.run_sorted([SPACE + x for x in new])):
            self.counts[word] = count
            if lone:
                self.lone.add(word)

    def segment(self, marks: int, word: str) -> int:
        """Tokens of ``marks`` space marks followed by ``word``. Runs of marks merge last, from
        the left, into the longest run piece."""
        if not word:
            return -(-marks // self.longest)
        count = self.counts[word]
        if marks == 1:
            return count
        return count - 1 - (-marks // self.longest) if word in self.lone else count - (-(marks - 1) // self.longest)

    def segments(self, marked: str) -> int:
        """Tokens of whole segments; ``marked`` starts with a space, or is empty."""
        words = marked.split(" ")[1:]
        different = set(words)
        self.learn(different)
        if "" not in different:
            return sum(map(self.counts.__getitem__, words))
        total, marks = 0, 0
        for word in words:
            marks += 1
            if word:
                total += self.segment(marks, word)
                marks = 0
        return total + (self.segment(marks, "") if marks else 0)

    def chunk(self, text: str) -> tuple[str, int, str] | tuple[str, None, None]:
        """The map of a chunk: what belongs to the segment that runs in from the left, tokens of
        the whole segments, and the segment that runs out to the right. A chunk without a start
        of a segment has only the first part. The middle is independent of the state at entry,
        because every start of a segment leads to the machine's start state."""
        begin = len(text) - len(text.lstrip(" "))
        begin = text.find(" ", begin)
        if begin < 0:
            return text, None, None
        end = text.rstrip(" ").rfind(" ")
        end = max(begin, len(text[: end + 1].rstrip(" ")))
        return text[:begin], self.segments(text[begin:end]), text[end:]

    def compose(self, one: tuple, two: tuple) -> tuple:
        """The map of two neighbouring chunks; associative."""
        if one[1] is None:
            return one[0] + two[0], two[1], two[2]
        if two[1] is None:
            return one[0], one[1], one[2] + two[0]
        return one[0], one[1] + self.segments(one[2] + two[0]) + two[1], two[2]

    def scan(self, maps: list[tuple]) -> tuple:
        """Neighbours are composed in rounds, as a parallel prefix scan does."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a whole text; an empty one has none."""
        if not text:
            return 0
        marked = " " + text.replace(SPACE, " ")
        if len(marked) <= chunk:
            return self.segments(marked)
        head, middle, tail = self.scan([self.chunk(marked[i : i + chunk]) for i in range(0, len(marked), chunk)])
        return self.segments(head) + (0 if middle is None else middle + self.segments(tail))


def loaded(path: str) -> Counter:
    """The compiled machine, kept by the Python worker from task to task."""
    return kept(("pieces", path), lambda: Counter(read_pieces(path)))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Whole texts are counted as the SentencePiece library would tokenize them, without begin or
    end marks. A null or empty text has no bytes and no tokens; repeated rows and null doc_ids
    keep a row each; long texts are mapped chunk by chunk; further columns play no part; an
    empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(path)
        for batch in batches:
            counts = pa.array([counter.count(x.as_py()) for x in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce("text", F.lit(""))
    source = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = source.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
