"""Parameters of the three analyses.

Fixed values: these equal the upstream analysis settings and must not drift.
  - rule mining: minimum support 0.001, minimum confidence 0.2, itemsets of at
    least 2 items, top 100 products by line count, rules kept when lift > 1,
    5 rules shown; maximum itemset length 10 (miner default)
  - model: 80 / 20 split, 50 rounds then 70 rounds, depth 6, learning rate 0.3,
    squared-error loss, threshold 0.7 (inclusive)
  - outcome labels "sim" (prediction right) and "não" (wrong)
  - list separators ", " (product names) and " " (product ids)
"""

from __future__ import annotations

from dataclasses import dataclass, field

MIN_SUPPORT = 0.001
MIN_CONFIDENCE = 0.2
MIN_ITEMS = 2
MAX_ITEMS = 10
TOP_N_PRODUCTS = 100
MIN_LIFT = 1.0
TOP_RULES = 5

TRAIN_FRACTION_PERCENT = 80
ROUNDS_FIRST = 50
ROUNDS_SECOND = 70
TREE_DEPTH = 6
LEARNING_RATE = 0.3
THRESHOLD = 0.7

LABEL_RIGHT = "sim"
LABEL_WRONG = "não"
NAME_SEPARATOR = ", "
ID_SEPARATOR = " "

LABEL_COL = "reordered"


@dataclass(frozen=True)
class RuleParams:
    min_support: float = MIN_SUPPORT
    min_confidence: float = MIN_CONFIDENCE
    top_n: int = TOP_N_PRODUCTS
    max_items: int | None = MAX_ITEMS  # None: no cut
    min_lift: float = MIN_LIFT


@dataclass(frozen=True)
class ModelParams:
    rounds: int = ROUNDS_FIRST
    depth: int = TREE_DEPTH
    learning_rate: float = LEARNING_RATE
    threshold: float = THRESHOLD
    train_percent: int = TRAIN_FRACTION_PERCENT
    seed: int = 42
    max_bins: int = 32
    checkpoint_interval: int = 10
    exclude: tuple = field(default=("eval_set", LABEL_COL))
