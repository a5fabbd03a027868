"""Thresholds, word lists and patterns."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Thresholds and lists as published with the quality heuristics
# (Rae et al. 2021, Raffel et al. 2020, Penedo et al. 2024).
# ---------------------------------------------------------------------------

GOPHER_STOP_WORDS = ("the", "be", "to", "of", "and", "that", "have", "with")

C4_POLICY_PHRASES = (
    "terms of use",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "use of cookies",
    "use cookies",
)

LINE_END_PUNCTUATION = (".", "?", "!", '"', "'")

# English stop words made of letters only; contractions never survive the letters-only rule.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what which
    who whom this that these those am is are was were be been being have has had having do
    does did doing a an the and but if or because as until while of at by for with about
    against between into through during before after above below to from up down in out on
    off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will
    just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma
    mightn mustn needn shan shouldn wasn weren won wouldn
    """.split()
)

# Log line layout of the evaluation table: | metric |value|±|stderr|
EVAL_METRIC = "truthfulqa_mc2"
EVAL_ROW = r"\|\s*({metric})\s*\|(\d\.\d{{3,4}})\|\s*±\s*\|(\d\.\d{{3,4}})\|"

BLOCK_SECONDS = 12
DAY_BLOCKS = 7200
DAY_SECONDS = 86_400
QUALITY_SHARE = 0.7
KEEP_SHARE = 0.8
LOW_SIMILARITY = 70.0
LOW_SHARE = 0.3
MIN_STAKE = 4096.0
WEIGHT_EPOCH_BLOCKS = 100
U16_MAX = 65_535
CAP_EPSILON = 1e-7
FLOOR_WEIGHT = 1e-5
SAMPLE_ROWS = 30

MINHASH_BANDS = 14
MINHASH_ROWS = 8
SHINGLE_WORDS = 5


@dataclass(frozen=True)
class GopherRepetition:
    dup_line: float = 0.30
    dup_paragraph: float = 0.30
    dup_line_chars: float = 0.20
    dup_paragraph_chars: float = 0.20
    top_ngram: dict[int, float] = field(default_factory=lambda: {2: 0.20, 3: 0.18, 4: 0.16})
    dup_ngram: dict[int, float] = field(
        default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
    )


@dataclass(frozen=True)
class GopherQuality:
    min_words: int = 50
    max_words: int = 100_000
    min_mean_length: float = 3.0
    max_mean_length: float = 10.0
    max_symbol_ratio: float = 0.1
    max_bullet_lines: float = 0.9
    max_ellipsis_lines: float = 0.3
    min_alpha_words: float = 0.8
    min_stop_words: int = 2
    stop_words: tuple[str, ...] = GOPHER_STOP_WORDS


@dataclass(frozen=True)
class C4Quality:
    min_line_words: int = 3
    max_word_length: int = 1000
    min_sentences: int = 5
    terminal_punctuation: bool = False
    policy_phrases: tuple[str, ...] = C4_POLICY_PHRASES


@dataclass(frozen=True)
class FineWebQuality:
    min_line_punctuation: float = 0.12
    short_line_chars: int = 30
    max_short_lines: float = 0.67
    max_dup_line_chars: float = 0.10
    max_newline_ratio: float = 0.3
