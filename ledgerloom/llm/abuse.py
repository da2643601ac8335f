"""Abusive, hateful or sexual content: gradient-boosted trees over dense lexical features, calibrated isotonically.

A text is folded (markup, zero-width characters, look-alike letters, accents, case), disguises are undone (digits and
signs for letters, single letters with separators, stretched letters, starred letters) and it is cut into sentences.
Of each sentence: densities of general lexicons by category, nearness of coarse words to second-person words, capitals,
punctuation, disguised and obfuscated words, and densities of two *learned lexicons*: log-odds of 6 and 10 letters in a
row, written together whatever stands between them, as the hand labels teach them. A document is a bag of sentences of
which one is enough, so its features are those of its worst sentence, the maxima over all, and the densities.

The learned lexicons come of two passes: documents first, then (several-instance learning) only the worst sentence of
each positive document against all sentences of the negative ones. Trees never see a document's features from a lexicon
that its own label helped to build: the folds of the lexicons are those of the calibration. Boosting starts at the base
rate; an isotonic fit on the held-out margins turns margins into probabilities.

Defined results: NULL and empty texts score 0; contradicting labels of a document are averaged, and a tie is no label;
labels of unknown documents are ignored; with fewer than ``LEAST_LABELS`` labels of either kind nothing is learned and
the general lexicons' evidence alone decides; repeated rows score alike; texts of any length are read whole.

Scale: scoring is a narrow map, computed for a whole Arrow batch at once in numpy. Only the labelled sample (at most
``TRAIN_LIMIT`` documents and ``TRAIN_CHARS`` characters, documented bounds, whole documents in the order of a hash of
their id) is joined by broadcast and collected; the model is a table of fixed size (``BUCKETS``) and some trees. Rates
per source are aggregated map-side.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.storage import materialize

TRAIN_LIMIT, TRAIN_CHARS, LEAST_LABELS, THRESHOLD = 20_000, 8_000_000, 12, 0.5
#: Characters that are taken apart at once (whole documents, at least one): about 60 bytes each while they are.
CHUNK_CHARS = 1_000_000
#: A label is doubted if its document's held-out probability of it is below this.
DOUBT = 0.12
#: Letters in a row that the learned lexicons weigh, and the slots their hashes fall into.
ORDERS, BUCKETS = (6, 10), 1 << 21

# ------------------------------------------------------------------------------------------------------------ lexicons
#: General lexicons of several languages. A word counts if it equals an entry, or begins with one that ends in a hyphen.
LEXICONS = {
    "insult": """idiot- moron- imbecil- cretin- dimwit- halfwit- nitwit- asshole- arsehole- bastard- bitch- cunt- twat- whore- slut-
        dickhead- shithead- dumbass- jackass- dipshit- scumbag- douche- wanker- tosser- bellend- prick- motherfuck- fuckwit- fuckface-
        retard- lowlife- scum faggot- nigger- loser- coward- degenerate- pervert- parasite-
        arschloch- hurensohn- wichser- schlampe- fotze- trottel- vollidiot- missgeburt- drecksau- dummkopf- spast
        idiota- estupid- gilipollas cabron- pendejo- hijoputa- subnormal- maricon- zorra
        babaca- otario- imbecis vagabund- desgracad- connard- salope- abruti- batard- encule- stronz- coglion- puttan-
        aptal- gerizekali- salak- serefsiz- pezevenk- orospu- ahmak- klootzak- hoer""",
    "coarse": """fuck- shit- bullshit- piss- arse ass asses crap- goddamn- cock cocks dick dicks pussy tits boob- balls
        scheiss- fick- fresse verpiss- foder foda- follar- joder puta- putain mierda- merda- merde caralho- sik- siktir- amk cazzo- vaffanculo""",
    "mild": """damn- bloody hell stupid- dumb- pathetic- worthless- useless- disgust- filth- ugly- miserable- brainless-
        mist verdammt- maldit- droga- kahretsin lanet- dumm- blod- ekel- asco- nojent- igren-""",
    "explicit": """porn- horny nude- naked nipple- pant- orgas- blowjob- handjob- xxx erotic- moan- masturb- cum cumming creampie- milf penis-
        vagina- anal clit- sex- strip- lick- suck- topless lingerie- nackt- geil- desnud- pelad- nua tesud- excitad- ciplak- azgin- seks-""",
    "violence": """kill- hang- skull- bullet- smash- ambulance- hospital- choke- burn- strangl- stab- shoot- shot rape- murder- beat- slit-
        throat- bury- dead die dies punch- knife- hurt- bleed- break- schlag- umbring- tote- mata- matar- romper- quebra- golpe- arrebent- oldur- gebert- vur-""",
    "dehuman": """vermin- subhuman- cockroach- rat rats disease- plague- infest- breed- savage- animals filth- exterminat- deport- expel-
        cleans- steriliz- sterilis- inferior- thieves- criminal- invad- creature- dirty ungeziefer- ratten- abschieb- schmarotz- ratas- ladron- echar-
        expuls- vermes- ladroes hirsiz- asalak- surmek-""",
    "group": """immigrant- foreigner- refugee- migrant- muslim- jews jewish christian- blacks gays lesbian- gypsies women girls natives
        auslander- fluchtling- zuwander- inmigrant- extranjer- imigrant- estrangeir- multeci- gocmen- yabanci-""",
    "second": """you your yours yourself yourselves u ur thou du dich dir dein deine deiner euch ihr tu te ti tus vos usted voce voces seu sua
        teu tua sen seni sana senin siz sizi toi vous votre ton""",
    "self": "i me my mine myself we our us ich mir mich mein meine wir yo mi mis eu meu minha ben benim je moi mon",
    "all": "all every everyone everybody they them their those these none nobody lot alle jeder todos todas tudo esos hepsi bunlar tous",
    "told": """word- rule- report- moderator- admin- ban banned insult- slur- threat- quote- said says call- article- film- book- song- story
        regel- beleidig- regla- insulto- regra- kural- hakaret- word wort palabra palavra""",
}
CATEGORIES = tuple(LEXICONS)
_CAT = {c: k for k, c in enumerate(CATEGORIES)}
#: Flags of a token beside its categories: a lexicon word in disguise, letters mixed with digits or signs, capitals.
_DISGUISED, _MIXED, _CAPITALS = (len(CATEGORIES) + k for k in range(3))
_WIDTH = len(CATEGORIES) + 3
#: Words of these categories are looked for behind disguises.
_HIDDEN = ("insult", "coarse", "explicit", "violence", "dehuman")

_LOOKALIKE = str.maketrans("аеорсухіјѕԁһкмтвнАЕОРСУХІЈЅКМТВНοαερικνυτΟΑΕΡΙΚΝΥΤı", "aeopcyxijsdhkmtbhAEOPCYXIJSKMTBHoaepikvutOAEPIKNYTi")
_UNSEEN = regex.compile(r"[\p{Mn}\p{Cf}]+")
_FOREIGN = re.compile(r"\S*[^\x00-\x7f\s]\S*")
_LATIN = re.compile("[A-Za-z]")
_LEET = str.maketrans("0134578@$!|€¡", "oieastbasilei")
_MARKUP = re.compile(r"<[^<>\n]*>|\[/?(?:quote|b|i|u|color|url|code|img|size)\b[^\]\n]*\]", re.I)
_SPACED = re.compile(r"(?<![^\W\d_])[^\W_](?:[ .\-_*·]{1,3}[^\W_]){3,}(?![^\W\d_])")
#: Cheaper to look for first: three letters pulled apart.
_MAYBE_SPACED = re.compile(r"[\s.\-_*·>\]\"'(,:;!?][^\W_][ .\-_*·]{1,3}[^\W_][ .\-_*·]{1,3}[^\W_][ .\-_*·]")
_JOINTS = re.compile(r"[ .\-_*·]")
_SENTENCE = re.compile(r"[.!?…]+(?:\s+|$)|\n+")
_TOKEN = re.compile(r"[^\W_][\w@$!|*#€¡'-]*[\w$*]|[@$][A-Za-z][\w@$!|*#€¡'-]*[\w$*]|\w")
_STRETCH = re.compile(r"(.)\1{2,}")
_RUNS = re.compile(r"(.)\1+")
_SIGNS = re.compile(r"[0-9@$!|€¡*#]")


@lru_cache(maxsize=1)
def _tables() -> tuple[dict[str, tuple[str, ...]], dict[str, list[tuple[str, str]]]]:
    """Whole words with their categories; stems by their first two letters."""
    whole: dict[str, list[str]] = {}
    stems: dict[str, list[tuple[str, str]]] = {}
    for category, words in LEXICONS.items():
        for w in words.split():
            if w.endswith("-"):
                stems.setdefault(w[:2], []).append((w[:-1], category))
            else:
                whole.setdefault(w, []).append(category)
    return {w: tuple(c) for w, c in whole.items()}, stems


def categories_of(word: str) -> set[str]:
    whole, stems = _tables()
    return {*whole.get(word, ()), *(c for stem, c in stems.get(word[:2], ()) if word.startswith(stem))}


@lru_cache(maxsize=1)
def _hidden_words() -> tuple[dict[str, str], dict[int, list[str]]]:
    """What starred and stretched words may stand for: without doubled letters, and by length."""
    words = [w.rstrip("-") for c in _HIDDEN for w in LEXICONS[c].split()]
    by_length: dict[int, list[str]] = {}
    for w in words:
        if len(w) > 3:
            for form in (w, w + "s", w + "ing"):
                by_length.setdefault(len(form), []).append(form)
    return {_RUNS.sub(r"\1", w): w for w in words if len(w) > 3}, by_length


def _repaired(word: re.Match) -> str:
    """A word whose UTF-8 bytes were once read as single characters, read rightly; else as it is."""
    try:
        return word[0].encode("cp1252").decode("utf-8")
    except UnicodeError:
        return word[0]


def _together(spaced: re.Match) -> str:
    """Letters pulled apart, joined; a single-letter word at either end stays a word of its own if that uncovers one."""
    word = _JOINTS.sub("", spaced[0])
    low = word.lower().translate(_LEET)
    if not categories_of(low):
        if categories_of(low[1:]) & set(_HIDDEN):
            return f"{word[0]} {word[1:]}"
        if categories_of(low[:-1]) & set(_HIDDEN):
            return f"{word[:-1]} {word[-1]}"
    return word


def fold(text: str) -> str:
    """Without markup, invisible characters, accents and (within words that also have Latin letters) look-alikes; letters
    that were pulled apart are joined."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text or "[" in text:
        text = _MARKUP.sub("\n", text)
    if "Ã" in text:
        text = re.sub(r"\S*Ã\S*", _repaired, text)
    if not text.isascii():
        text = _UNSEEN.sub("", unicodedata.normalize("NFKD", text))
        text = _FOREIGN.sub(lambda m: m[0].translate(_LOOKALIKE) if _LATIN.search(m[0]) else m[0].replace("ı", "i"), text)
    text = text.replace("’", "'")
    return _SPACED.sub(_together, text) if _MAYBE_SPACED.search(" " + text) else text


def plain_word(token: str) -> tuple[str, bool]:
    """The word a token stands for, in lower case, and whether it had to be uncovered."""
    low = token.lower()
    if categories_of(low):
        return low, False
    bare = low.replace("'", "").replace("-", "")
    if bare != low and len(bare) > 3 and categories_of(bare) & set(_HIDDEN):
        return bare, True
    squeezed, by_length = _hidden_words()
    if _SIGNS.search(bare) and not bare.isdigit():
        leet = bare.translate(_LEET)
        if categories_of(leet):
            return leet, True
        if "*" in bare or "#" in bare:
            pattern = re.compile("".join("." if c in "*#" else re.escape(c) for c in leet) + "$")
            for w in by_length.get(len(leet), ()):
                if pattern.match(w):
                    return w, True
        bare = leet
    if _STRETCH.search(bare):
        w = squeezed.get(_RUNS.sub(r"\1", bare))
        if w:
            return w, True
    return low, False


class _Vocabulary(dict):
    """Tokens numbered as they come, with their flags and what they are written out as. It only saves work, and is emptied
    when large."""

    def __init__(self):
        super().__init__()
        self.table = np.zeros((1 << 14, _WIDTH), np.float32)
        self.plain: list[str] = []

    def __missing__(self, token: str) -> int:
        word, disguised = plain_word(token)
        found = categories_of(word)
        mixed = len(token) > 2 and bool(_SIGNS.search(token, 1)) and bool(_LATIN.search(token)) and not token[0].isdigit()
        row = (*(c in found for c in CATEGORIES), disguised, mixed, len(token) > 1 and token.isupper() and token.isalpha())
        k = self[token] = len(self.plain)
        if k == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[k] = row
        self.plain.append(word.translate(_LEET) if mixed and not disguised else word)
        return k

    def empty(self) -> None:
        self.clear()
        self.plain.clear()


_VOCABULARY = _Vocabulary()


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters (of the basic plane; all beyond count as letters)."""
    return np.array([chr(k).isalpha() for k in range(1 << 16)])


@dataclass(frozen=True)
class Parsed:
    """Texts taken apart: sentences with their document, tokens' flags with their sentence, letters in a row, hashed."""

    documents: int
    doc: np.ndarray  # of sentences
    flags: np.ndarray  # of tokens
    sentence: np.ndarray  # of tokens
    marks: np.ndarray  # of sentences: signs of excitement a character
    grams: tuple[np.ndarray, ...]  # by order: slots
    gram_sentence: tuple[np.ndarray, ...]


def parse(texts: list[str | None]) -> Parsed:
    if len(_VOCABULARY) > 500_000:
        _VOCABULARY.empty()
    number, written, ids, lengths, docs, marks, plain = _VOCABULARY, _VOCABULARY.plain, [], [], [], [], []
    for k, text in enumerate(texts):
        if not text:
            continue
        for s in _SENTENCE.split(fold(text)):
            tokens = _TOKEN.findall(s)
            if tokens:
                here = [number[t] for t in tokens]
                ids += here
                lengths.append(len(tokens))
                docs.append(k)
                marks.append((s.count("!") + s.count("*")) / len(s))
                plain.append("".join([written[i] for i in here]))
    n = len(docs)
    flags = number.table[np.array(ids, dtype=np.int64)] if ids else np.zeros((0, _WIDTH), np.float32)
    sentence = np.repeat(np.arange(n), np.array(lengths, dtype=np.int64)) if n else np.zeros(0, np.int64)
    codes = np.frombuffer("\n".join(plain).encode("utf-32-le", "replace"), dtype=np.uint32)
    of = np.cumsum(codes == 10)
    kept = _letters()[np.minimum(codes, 0xFFFF)] | (codes > 0xFFFF)
    codes, of = codes[kept].astype(np.uint64), of[kept]
    short = ORDERS[0]
    h = np.zeros(max(0, len(codes) - short + 1), dtype=np.uint64)
    for k in range(short):
        h *= np.uint64(0x100000001B3)
        h += codes[k : k + len(h)]
    slots, where = [], []
    for order in ORDERS:
        m = max(0, len(codes) - order + 1)
        # The longer ones are made of two short ones that overlap.
        mixed = h[:m] if order == short else h[:m] * np.uint64(0x9E3779B97F4A7C15) + h[order - short : order - short + m]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        inside = of[:m] == of[order - 1 : order - 1 + m]
        slots.append((mixed[inside] >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32))
        where.append(of[:m][inside].astype(np.int32))
    return Parsed(len(texts), np.array(docs, dtype=np.int64), flags, sentence, np.array(marks), tuple(slots), tuple(where))


# ---------------------------------------------------------------------------------------------------- learned lexicons
def _odds(good: np.ndarray, bad: np.ndarray, n_good: float, n_bad: float) -> np.ndarray:
    """Log-odds of slots by how many units of either kind show them, drawn towards 0 by their standard error; 0 for slots
    that fewer than three show."""
    out = np.zeros(len(good), dtype=np.float32)
    at = np.flatnonzero(good + bad >= 3)
    g, b = good[at] + 0.5, bad[at] + 0.5
    w = np.log(b / (n_bad + 1)) - np.log(g / (n_good + 1))
    out[at] = np.sign(w) * np.maximum(0, np.abs(w) - 0.7 * np.sqrt(1 / b + 1 / g))
    return out


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending."""
    values = np.sort(values)
    return values[np.diff(values, prepend=values[:1] - 1) != 0]


@dataclass(frozen=True)
class _Shown:
    """Which slots a unit shows, each pair once; by order, for documents and for sentences as units."""

    parsed: Parsed
    of_documents: tuple[tuple[np.ndarray, np.ndarray], ...]
    of_sentences: tuple[tuple[np.ndarray, np.ndarray], ...]

    @staticmethod
    def of(parsed: Parsed) -> _Shown:
        def once(unit: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            pairs = _distinct(unit.astype(np.int64) * BUCKETS + slots)
            return (pairs // BUCKETS).astype(np.int32), (pairs % BUCKETS).astype(np.int32)

        grams = list(zip(parsed.grams, parsed.gram_sentence))
        return _Shown(parsed, tuple(once(parsed.doc[where], slots) for slots, where in grams), tuple(once(where, slots) for slots, where in grams))


def _tally(shown: tuple[np.ndarray, np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """In how many chosen units each slot occurs."""
    unit, slots = shown
    return np.bincount(slots[chosen[unit]], minlength=BUCKETS).astype(np.float64)


def learn_lexicons(shown: _Shown, y: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, ...]:
    """Weights of all slots by order, from the documents of ``use`` (a mask) with labels ``y``."""
    parsed = shown.parsed
    bad, good = use & (y > 0.5), use & (y <= 0.5)
    first = [_odds(_tally(s, good), _tally(s, bad), good.sum(), bad.sum()) for s in shown.of_documents]
    # The second pass: of a positive document its worst sentence stands for all, unless nothing in it looks bad at all.
    total = sum(_mean(parsed, k, w[parsed.grams[k]]) for k, w in enumerate(first))
    worst = _worst(parsed, total)
    picked = np.zeros(len(parsed.doc), dtype=bool)
    picked[worst[worst >= 0]] = True
    picked &= total > 0
    bad_s, good_s = bad[parsed.doc] & picked, good[parsed.doc]
    return tuple(_odds(_tally(s, good_s), _tally(s, bad_s), good_s.sum(), bad_s.sum()) for s in shown.of_sentences)


def _mean(parsed: Parsed, k: int, values: np.ndarray) -> np.ndarray:
    """By sentence, of one order: the mean of a value of its slots; 0 where it has none."""
    n, where = len(parsed.doc), parsed.gram_sentence[k]
    return np.bincount(where, values, n) / np.maximum(np.bincount(where, minlength=n), 1)


def _means(parsed: Parsed, k: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By sentence, of one order: the mean weight, the greatest, and the share of slots that speak for it."""
    n, where = len(parsed.doc), parsed.gram_sentence[k]
    w = weights[parsed.grams[k]]
    most = np.zeros(n, dtype=np.float32)
    if len(w):
        starts = np.flatnonzero(np.diff(where, prepend=-1))  # slots come in the order of their sentences
        most[where[starts]] = np.maximum(np.maximum.reduceat(w, starts), 0)
    return _mean(parsed, k, w), most, _mean(parsed, k, w > 1)


def _worst(parsed: Parsed, badness: np.ndarray) -> np.ndarray:
    """The index of each document's worst sentence; -1 where it has none."""
    out = np.full(parsed.documents, -1, dtype=np.int64)
    order = np.argsort(badness, kind="stable")
    out[parsed.doc[order]] = order
    return out


# ------------------------------------------------------------------------------------------------------------ features
_LEARNED = tuple(f"{f}_{k}" for k in ORDERS for f in ("mean", "most", "share"))
SENTENCE_FEATURES = (*CATEGORIES, "disguised", "mixed", "capitals", "near", "marks", "directed", "against_group", "menace", "evidence", *_LEARNED)
_DENSE = ("insult", "coarse", "mild", "explicit", "violence", "dehuman", "disguised", "mixed", "capitals")
FEATURES = (*(f"max_{f}" for f in SENTENCE_FEATURES), *(f"worst_{f}" for f in SENTENCE_FEATURES), *(f"per_100_{f}" for f in _DENSE), "log_tokens")


def _nearness(a: np.ndarray, b: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
    """By sentence: 1 / (1 + least distance in words) between a word of ``a`` and one of ``b`` (positions, ascending)."""
    out = np.zeros(n)
    if not len(a) or not len(b):
        return out
    after = np.searchsorted(b, a)
    for at in (np.minimum(after, len(b) - 1), np.maximum(after - 1, 0)):
        same = sentence[b[at]] == sentence[a]
        np.maximum.at(out, sentence[a[same]], 1 / (1 + np.abs(b[at[same]] - a[same])))
    return out


def _plain_table(parsed: Parsed) -> tuple[np.ndarray, np.ndarray]:
    """The features of each sentence that no learned lexicon has part in, and its number of tokens."""
    n = len(parsed.doc)
    if not n:
        return np.zeros((0, len(SENTENCE_FEATURES) - len(_LEARNED))), np.zeros(0)
    starts = np.flatnonzero(np.diff(parsed.sentence, prepend=-1))
    counts = np.add.reduceat(parsed.flags, starts, axis=0)
    tokens = np.bincount(parsed.sentence, minlength=n).astype(np.float64)
    at = lambda *names: np.flatnonzero(parsed.flags[:, [_CAT[c] for c in names]].any(axis=1))
    c = {name: counts[:, k] for name, k in _CAT.items()}
    second = at("second")
    near = _nearness(at("insult", "coarse"), second, parsed.sentence, n)
    menace = _nearness(at("violence"), second, parsed.sentence, n) * (c["violence"] + (c["self"] > 0))
    directed = (c["insult"] > 0) * ((c["second"] > 0) + (c["all"] > 0) + 0.5 * (c["self"] == 0))
    against = np.minimum(c["group"], 1) * np.minimum(c["dehuman"] + c["insult"], 2)
    evidence = directed + against + 0.6 * (c["explicit"] + c["coarse"] >= 2) + 0.4 * c["explicit"] + 0.5 * near * (c["coarse"] > 0) + 0.4 * menace + counts[:, _DISGUISED] - 0.5 * c["told"]
    columns = [*counts.T[: len(CATEGORIES)], counts[:, _DISGUISED], counts[:, _MIXED], counts[:, _CAPITALS] / tokens, near, parsed.marks]
    return np.stack([*columns, directed, against, menace, evidence], axis=1).astype(np.float64), tokens


def dense(parsed: Parsed, lexicons: tuple[np.ndarray, ...] | None, plain: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """The features of each document, in the order of ``FEATURES``. ``plain``: what ``_plain_table`` gave, if it is known."""
    width, d, n = len(SENTENCE_FEATURES), parsed.documents, len(parsed.doc)
    out = np.zeros((d, len(FEATURES)))
    if not n:
        return out
    table, tokens = plain or _plain_table(parsed)
    learned = [f for k in range(len(ORDERS)) for f in (_means(parsed, k, lexicons[k]) if lexicons is not None else [np.zeros(n)] * 3)]
    table = np.concatenate([table, np.stack(learned, axis=1)], axis=1)
    starts = np.flatnonzero(np.diff(parsed.doc, prepend=-1))
    mine = parsed.doc[starts]
    out[mine, :width] = np.maximum.reduceat(table, starts, axis=0)
    means = [SENTENCE_FEATURES.index(f"mean_{k}") for k in ORDERS]
    badness = table[:, means].sum(axis=1) if lexicons is not None else table[:, SENTENCE_FEATURES.index("evidence")]
    out[mine, width : 2 * width] = table[_worst(parsed, badness)[mine]]
    total = np.add.reduceat(tokens, starts)
    sums = np.add.reduceat(table[:, [SENTENCE_FEATURES.index(f) for f in _DENSE]], starts, axis=0)
    out[mine, 2 * width : -1] = 100 * sums / total[:, None]
    out[mine, -1] = np.log1p(total)
    return out


def features(text: str | None) -> np.ndarray:
    """The dense features of one text without any learned lexicon."""
    return dense(parse([text]), None)[0]


# --------------------------------------------------------------------------------------------------------------- model
_EVIDENCE = FEATURES.index("max_evidence")


@dataclass(frozen=True)
class Tree:
    """feature, threshold and children by node; a leaf has feature -1 and a value."""

    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(len(self.feature)):
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                break
            node = at[inner]
            at[inner] = np.where(x[inner, feature[node]] <= threshold[node], left[node], right[node])
        return np.array(self.value)[at]


#: Cut points of a feature; also the width of its histogram.
_CUTS = 32


def grow(bins: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], depth: int, least: float, ridge: float) -> Tree:
    """One regression tree on gradients and curvatures. ``bins``: by row and feature, the number of cut points below the
    value, offset so that all features share one histogram."""
    nodes: list[list] = []
    columns = len(cuts)
    real = np.arange(_CUTS + 1)[None, :] < np.array([len(c) for c in cuts])[:, None]

    def build(rows: np.ndarray, level: int) -> int:
        me = len(nodes)
        of_g, of_h = g[rows], h[rows]
        G, H = of_g.sum(), of_h.sum()
        nodes.append([-1, 0.0, 0, 0, G / (H + ridge)])
        if level == depth or H < 2 * least:
            return me
        flat = bins[rows].ravel()
        size = columns * (_CUTS + 1)
        gl = np.bincount(flat, np.repeat(of_g, columns), size).reshape(columns, -1).cumsum(axis=1)
        hl = np.bincount(flat, np.repeat(of_h, columns), size).reshape(columns, -1).cumsum(axis=1)
        gain = gl**2 / (hl + ridge) + (G - gl) ** 2 / (np.maximum(H - hl, 0) + ridge) - G**2 / (H + ridge)
        gain[(hl < least) | (H - hl < least) | ~real] = 0
        j, k = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if gain[j, k] > 1e-6:
            low = bins[rows, j] - j * (_CUTS + 1) <= k
            nodes[me][:2] = [int(j), float(cuts[j][k])]
            nodes[me][2] = build(rows[low], level + 1)
            nodes[me][3] = build(rows[~low], level + 1)
        return me

    build(np.arange(len(g)), 0)
    return Tree(*(tuple(c) for c in zip(*nodes)))


@dataclass(frozen=True)
class Boosted:
    base: float
    trees: tuple[Tree, ...]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out = out + tree.predict(x)
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, rate: float = 0.15, depth: int = 3, least: float = 3.0, ridge: float = 2.0) -> Boosted:
    """Gradient boosting of the logistic loss from the base rate; leaf values are already scaled by the rate."""
    cuts = []
    for j in range(x.shape[1]):
        values = _distinct(x[:, j])
        middle = (values[1:] + values[:-1]) / 2
        cuts.append(middle if len(middle) <= _CUTS else np.unique(np.quantile(middle, np.linspace(0, 1, _CUTS))))
    bins = np.stack([np.searchsorted(points, x[:, j], side="left") + j * (_CUTS + 1) for j, points in enumerate(cuts)], axis=1)
    rated = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base, trees = float(np.log(rated / (1 - rated))), []
    margin = np.full(len(y), base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(bins, y - p, p * (1 - p), cuts, depth, least, ridge)
        tree = Tree(tree.feature, tree.threshold, tree.left, tree.right, tuple(rate * v for v in tree.value))
        margin = margin + tree.predict(x)
        trees.append(tree)
    return Boosted(base, tuple(trees))


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots and non-decreasing values, to be interpolated between."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, lowest and highest score
    for s, v in zip(score[order], y[order]):
        blocks.append([v, 1.0, s, s])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] >= blocks[-1][2]):
            m, w, _, high = blocks.pop()
            b = blocks[-1]
            b[0], b[1], b[3] = (b[0] * b[1] + m * w) / (b[1] + w), b[1] + w, high
    knots = [x for b in blocks for x in (b[2], b[3])]
    values = [v for b in blocks for v in (b[0], b[0])]
    return np.array(knots), np.array(values)


@dataclass(frozen=True)
class Model:
    """Lexicons as slots and weights by order, trees, and the knots of the calibration. Without trees: the evidence."""

    lexicons: tuple[tuple[np.ndarray, np.ndarray], ...] = ()
    boosted: Boosted | None = None
    knots: np.ndarray = field(default_factory=lambda: np.zeros(0))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def tables(self) -> tuple[np.ndarray, ...] | None:
        """The lexicons as tables of all slots."""
        if self.boosted is None:
            return None
        out = []
        for slots, weights in self.lexicons:
            table = np.zeros(BUCKETS, dtype=np.float32)
            table[slots] = weights
            out.append(table)
        return tuple(out)

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.boosted is None:
            return 1 / (1 + np.exp(-(4 * x[:, _EVIDENCE] - 4)))
        return np.interp(self.boosted.margin(x), self.knots, self.values)


def _held_out(shown: _Shown, y: np.ndarray, use: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of all documents from lexicons of the other folds, and their margins from trees of the other folds;
    only documents of ``use`` teach anything."""
    x, held = np.zeros((len(y), len(FEATURES))), np.zeros(len(y))
    plain = _plain_table(shown.parsed)
    for k in range(part.max() + 1):
        x[part == k] = dense(shown.parsed, learn_lexicons(shown, y, use & (part != k)), plain)[part == k]
    for k in range(part.max() + 1):
        held[part == k] = boost(x[use & (part != k)], y[use & (part != k)]).margin(x[part == k])
    return x, held


def fit(texts: list[str], y: np.ndarray, folds: int = 5) -> Model:
    """A model of labelled texts. Each fifth gets its features from lexicons of the others, and its held-out margin from
    trees of the others. Labels that their document's held-out probability contradicts (``DOUBT``) are taken for errors of
    the hand and left out of a second round, whose lexicons, trees and calibration are kept."""
    if min((y > 0.5).sum(), (y <= 0.5).sum()) < LEAST_LABELS:
        return Model()
    shown = _Shown.of(parse(texts))
    part, use = np.arange(len(y)) % folds, np.ones(len(y), dtype=bool)
    x, held = _held_out(shown, y, use, part)
    p = np.interp(held, *isotonic(held, y))
    doubted = (np.abs(y - p) > 1 - DOUBT) & ~((y > 0.5) & (x[:, _EVIDENCE] >= 1))
    if min((y[~doubted] > 0.5).sum(), (y[~doubted] <= 0.5).sum()) >= LEAST_LABELS:
        use = ~doubted
    x, held = _held_out(shown, y, use, part)
    knots, values = isotonic(held[use], y[use])
    lexicons = learn_lexicons(shown, y, use)
    kept = tuple((np.flatnonzero(w).astype(np.int32), w[w != 0].astype(np.float16)) for w in lexicons)
    return Model(kept, boost(x[use], y[use]), knots, values)


# --------------------------------------------------------------------------------------------------------------- Spark
def labelled(documents: DataFrame, labels: DataFrame, row_id: str, text: str, label: str, limit: int = TRAIN_LIMIT, chars: int = TRAIN_CHARS) -> DataFrame:
    """y and text of the sample: labelled documents in the order of a hash of their id, as many as the bounds admit."""
    voted = labels.where(F.col(label).isNotNull() & F.col(row_id).isNotNull()).groupBy(F.col(row_id).alias("id")).agg(F.avg(label).alias("y"))
    voted = voted.where("y != 0.5").orderBy(F.xxhash64("id"), "id").limit(limit)
    texts = documents.select(F.col(row_id).alias("id"), F.col(text).alias("text"))
    sample = texts.join(F.broadcast(voted), "id").where("text IS NOT NULL AND text != ''").select("id", F.xxhash64("id").alias("h"), "y", "text")
    sample = materialize(sample.dropDuplicates(["id"]), "labelled")
    # Lengths only, of at most ``limit`` documents, pass through one task.
    upto = F.sum("n").over(Window.orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0))
    kept = sample.select("id", "h", F.length("text").alias("n")).withColumn("upto", upto).where(F.col("upto") <= chars)
    return sample.join(F.broadcast(kept.select("id")), "id", "left_semi").select("h", "y", "text")


def train(documents: DataFrame, labels: DataFrame, row_id: str, text: str, label: str, limit: int = TRAIN_LIMIT) -> Model:
    """A model from hand labels (1 or 0, possibly several for a document) of at most ``limit`` documents."""
    rows = labelled(documents, labels, row_id, text, label, limit).toPandas()
    if not len(rows):
        return Model()
    rows = rows.sort_values("h", kind="stable")  # folds and trees do not depend on how tasks end
    return fit(rows["text"].tolist(), (rows["y"].to_numpy() > 0.5).astype(float))


def chunks(texts: list[str | None], most: int = CHUNK_CHARS) -> Iterator[list[str | None]]:
    """The texts in order, as many at once as have at most ``most`` characters together."""
    at = size = 0
    for k, text in enumerate(texts):
        n = len(text or "")
        if k > at and size + n > most:
            yield texts[at:k]
            at, size = k, 0
        size += n
    if at < len(texts):
        yield texts[at:]


def score(documents: DataFrame, row_id: str, text: str, source: str, model: Model) -> DataFrame:
    """row id, source and the probability that the text holds abusive, hateful or sexual language."""
    kind = documents.schema[row_id].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a table of fixed size and some trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value.tables()
        for batch in batches:
            texts = batch["text"].to_pylist()
            x = [dense(parse(part), tables) for part in chunks(texts)]
            p = np.where([bool(t) for t in texts], shared.value.probability(np.concatenate(x)), 0.0) if texts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["source"], pa.array(p, pa.float64())], names=["id", "source", "probability"])

    rows = documents.select(F.col(row_id).alias("id"), F.col(source).cast("string").alias("source"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, source string, probability double").toDF(row_id, source, "probability")


def rates(scored: DataFrame, source: str, threshold: float = THRESHOLD) -> DataFrame:
    """Documents, flagged documents, their share and the mean probability, per source."""
    flagged = F.count_if(F.col("probability") >= threshold)
    return scored.groupBy(source).agg(
        F.count(F.lit(1)).alias("documents"), flagged.alias("flagged"), (flagged / F.count(F.lit(1))).alias("rate"), F.avg("probability").alias("mean_probability")
    )
