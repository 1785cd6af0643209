"""Fixed values.

These must equal the values of the jobs this package rebuilds, for the same
results. They are stated here once, plainly, and imported where used.
"""

# Boosted regression trees (expansion and leaf-feature jobs).
GBT_ITERATIONS = 50
GBT_DEPTH = 3
GBT_STEP = 0.5
GBT_MIN_INSTANCES = 1

# Logistic regression (L-BFGS, L2 penalty, intercept).
LR_MAX_ITER = 5000
LR_REG_PARAM = 0.6
LR_TOL = 1e-6

# Populations.
NEGATIVES_PER_POSITIVE = 10      # sampling ratio = min(1, 10 * seeds / others)
SAMPLE_SEED = 1                  # negative sample
SPLIT_SEED = 11                  # 50/50 split of the leaf-feature job
CYCLE_TOKEN = 7                  # a user is "inside the cycle" when its cycle holds ,7,

# Evaluation. The confusion matrix uses >=, the binarised AUC and
# the expansion size use a strict >.
THRESHOLD = 0.5

# Text sources and score files.
NULL_WORD = "null"               # a seed or column line equal to this is skipped
TREE_SCORE_SEP = "\u0001"        # score file separator of the tree job
LINEAR_SCORE_SEP = ","           # score file separator of the logistic job
