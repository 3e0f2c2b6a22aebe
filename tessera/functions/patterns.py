"""Pattern dictionaries as data, and the columns that apply them.

Patterns are written in the common part of Python's and Java's regular expressions. ``(?U)`` gives Java Python's idea of
word characters, white space and word ends; ``(?d)`` leaves LF as the only line end that a dot doesn't match.
"""

from __future__ import annotations

import re
from functools import reduce
from re import _constants as _C  # the tree of a parsed pattern, which re doesn't give otherwise
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import one_line

FLAGS = "(?Ud)"
FLAGS_ANY_CASE = "(?Uidu)"

#: Phrases of editorials; each is its own label.
EDITORIAL_PHRASES = [
    "dynamic programming",
    "dynamic-programming",
    "dp solution",
    "dp state",
    "dp transition",
    "dp recurrence",
    "dynamic programming approach",
    "memoization",
    "state transition",
    "recurrence",
    "subproblem",
]
#: Tags that hint at dynamic programming.
WEAK_TAGS = ["bitmasks", "probabilities", "games", "trees", "graphs", "combinatorics", "strings", "matrices"]
#: Signals of a solution, looked for in flattened lower-case code.
CODE_SIGNALS = {
    "dp_array_name": r"\b(?:dp|f|g|memo|mem)\s*(?:\[|\(|=)",
    "dp_vector": r"\b(?:vector|array)\s*<[^>]+>\s+(?:dp|f|g|memo|mem)\b",
    "dp_2d": r"\b(?:dp|f|g|memo|mem)\s*\[[^]]+\]\s*\[[^]]+\]",
    "memoization": r"\b(?:memo|memoized|memoization|cache)\b",
    "recursion": r"\b(?:dfs|solve|go|rec|calc|search)\s*\([^;{}]*\)\s*\{",
    "transition": r"\b(?:dp|f|g)\s*\[[^]]+\]\s*(?:=|\+=|-=)",
    "previous_state": r"\b(?:dp|f|g)\s*\[[^]]+\].*\b(?:dp|f|g)\s*\[[^]]+\]",
    "knapsack_pattern": r"\b(?:weight|weights|capacity|knapsack|\bw\b.*\bc\b)\b",
    "lis_pattern": r"\b(?:lis|longest increasing|increasing subsequence)\b",
    "lcs_pattern": r"\b(?:lcs|longest common subsequence)\b",
    "interval_pattern": r"\b(?:interval|range|l\b.*r\b|left.*right)\b",
    "bitmask_pattern": r"\b(?:mask|1\s*<<|1LL\s*<<)\b",
    "tree_dp_pattern": r"\b(?:subtree|tree dp|reroot|children)\b",
    "digit_dp_pattern": r"\b(?:digit dp|tight|leading.?zero)\b",
}
#: The weights of signals by kind.
STRONG = ["dp_array_name", "dp_vector", "dp_2d", "memoization", "transition", "previous_state"]
STRUCTURAL = ["recursion", "knapsack_pattern", "lis_pattern", "lcs_pattern", "interval_pattern", "tree_dp_pattern", "digit_dp_pattern"]
WEAK = ["bitmask_pattern"]
#: Families of problems by what their texts say.
FAMILIES = {
    "knapsack": [
        r"\bknapsack\b", r"\bsubset sum\b", r"\bsubset-sum\b", r"\bbounded knapsack\b", r"\bunbounded knapsack\b",
        r"\b0[/ -]?1 knapsack\b", r"\bweight\b.{0,80}\bcapacity\b", r"\bcapacity\b.{0,80}\bweight\b",
    ],
    "sequence": [
        r"\blongest increasing subsequence\b", r"\blongest decreasing subsequence\b", r"\bincreasing subsequence\b",
        r"\bdecreasing subsequence\b", r"\blis\b", r"\blnds\b", r"\blcs\b", r"\blongest common subsequence\b",
    ],
    "string": [
        r"\bstring\b", r"\bstrings\b", r"\bsubstring\b", r"\bpalindrome\b", r"\bpalindromic\b",
        r"\blongest common subsequence\b", r"\blcs\b", r"\bedit distance\b", r"\bstring matching\b",
    ],
    "interval": [
        r"\binterval dp\b", r"\brange dp\b", r"\binterval dynamic programming\b", r"\bdp\s*\[\s*l\s*\]\s*\[\s*r\s*\]",
        r"\bdp\s*\[\s*l\s*\]\s*\[\s*r\s*[+-]", r"\bmerge\b.{0,80}\bintervals?\b", r"\bpartition\b.{0,80}\binterval\b",
        r"\bpartition\b.{0,80}\bsegment\b", r"\bmatrix chain\b", r"\boptimal binary search tree\b",
    ],
    "tree": [
        r"\btree dp\b", r"\btree dynamic programming\b", r"\bsubtree\b", r"\breroot(?:ing)?\b",
        r"\bon the tree\b", r"\brooted tree\b", r"\bchildren of\b", r"\bparent of\b",
    ],
    "graph_dag": [
        r"\bdp on (?:a )?dag\b", r"\bdag dp\b", r"\bdirected acyclic graph\b", r"\bdirected acyclic\b",
        r"\btopological sort\b", r"\btopological ordering\b", r"\btoposort\b", r"\bDAG\b",
    ],
    "bitmask": [
        r"\bbitmask dp\b", r"\bbitmask dynamic programming\b", r"\bmask dp\b", r"\bsubset dp\b",
        r"\bSOS DP\b", r"\bsum over subsets\b", r"\b1\s*<<\s*\w+", r"\b1LL\s*<<\s*\w+",
    ],
    "digit": [
        r"\bdigit dp\b", r"\bdigit dynamic programming\b", r"\btight\b.{0,80}\bdigit\b",
        r"\bdigits?\b.{0,80}\btight\b", r"\bleading zeros?\b.{0,80}\bdp\b",
    ],
    "game": [
        r"\bgame dp\b", r"\bgame dynamic programming\b", r"\bwinning position\b", r"\blosing position\b",
        r"\bwinning state\b", r"\bgrundy\b", r"\bsprague[- ]grundy\b", r"\bnim\b",
    ],
    "probability": [
        r"\bprobability dp\b", r"\bprobability dynamic programming\b", r"\bexpected value\b", r"\bexpected number\b",
        r"\bexpected cost\b", r"\bexpectation dp\b", r"\bprobability\b.{0,100}\bdp\b",
    ],
    "grid": [
        r"\bgrid dp\b", r"\bgrid dynamic programming\b", r"\bmatrix dp\b", r"\bmatrix dynamic programming\b",
        r"\brows?\b.{0,60}\bcolumns?\b.{0,60}\bdp\b", r"\bgrid\b.{0,100}\bdp\b",
    ],
    "counting": [
        r"\bcounting dp\b", r"\bcounting dynamic programming\b", r"\bnumber of ways\b.{0,80}\bdp\b",
        r"\bways\b.{0,80}\bdp\b", r"\bcount\b.{0,80}\bdp\b", r"\bcombinatorial dp\b",
    ],
}
#: Optimisations.
OPTIMIZATIONS = {
    "binary_search": [r"\bbinary search\b", r"\bparametric search\b"],
    "prefix_sum": [r"\bprefix sum\b", r"\bprefix sums\b", r"\bcumulative sum\b"],
    "monotonic_queue": [r"\bmonotonic queue\b", r"\bmonotonic deque\b", r"\bsliding window\b"],
    "segment_tree": [r"\bsegment tree\b", r"\bsegtree\b"],
    "fenwick_tree": [r"\bfenwick tree\b", r"\bbinary indexed tree\b"],
    "divide_conquer_optimization": [r"\bdivide and conquer optimization\b", r"\bdivide[- ]and[- ]conquer dp\b", r"\bd&c optimization\b"],
    "convex_hull_trick": [r"\bconvex hull trick\b", r"\bcht\b"],
    "knuth_optimization": [r"\bknuth optimization\b", r"\bknuth dp\b"],
}
#: What states are made of.
STATES = {
    "position": [r"\bposition\b", r"\bindex\b", r"\bidx\b"],
    "capacity": [r"\bcapacity\b", r"\bbudget\b"],
    "previous_state": [r"\bprevious state\b", r"\bstate transition\b"],
    "color": [r"\bcolor\b", r"\bcolors\b"],
    "mask": [r"\bbitmask\b", r"\bmask dp\b"],
    "last_element": [r"\blast element\b", r"\bprevious element\b", r"\blast value\b", r"\bprevious value\b"],
    "left_right": [r"\binterval dp\b", r"\brange dp\b", r"\bdp\s*\[\s*l\s*\]\s*\[\s*r\s*\]"],
}
#: What is counted in verified code, case kept.
CODE_COUNTS = {
    "array_dp": [r"\bvector\s*<[^;\n]+>\s+dp\b", r"\bvector\s*<[^;\n]+>\s+dp\s*\[", r"\b(?:long long|int|double)\s+dp\s*\[", r"\b(?:long long|int|double)\s+dp\d*\s*\["],
    "two_dimensional_dp": [r"\bdp\s*\[[^\]]+\]\s*\[[^\]]+\]", r"\bvector\s*<\s*vector\s*<[^>]+>\s*>\s+dp"],
    "memoization": [r"\bmemo\b", r"\bmem\b", r"\bcache\b", r"\bunordered_map\s*<[^;]+>\s+memo", r"\bmap\s*<[^;]+>\s+memo"],
    "recursive_dp": [r"\bdfs\s*\(", r"\bsolve\s*\(", r"\brec(?:ursive)?\s*\("],
    "previous_state": [r"\bdp\s*\[[^\]]+\]\s*=\s*[^;\n]*\bdp\s*\[", r"\bdp\s*\[[^\]]+\]\s*=\s*[^;\n]*\b(?:i\s*-\s*1|i\s*-\s*2|j\s*-\s*1|j\s*-\s*2)\b"],
    "transition": [r"\bmax\s*\(", r"\bmin\s*\(", r"\bdp\s*\[[^\]]+\]\s*(?:\+|-|\*)=", r"\bdp\s*\[[^\]]+\]\s*="],
    "knapsack": [r"\bweight\b", r"\bvalue\b", r"\bcapacity\b", r"\bknapsack\b", r"\bfor\s*\([^)]*capacity"],
    "bitmask": [r"\b(?:1\s*<<|1LL\s*<<)", r"\bmask\b", r"\bpopcount\b", r"__builtin_popcount"],
    "interval": [r"\bl\b.*\br\b", r"\bleft\b", r"\bright\b", r"\binterval\b", r"\bdp\s*\[[^\]]+\]\s*\[[^\]]+\]"],
    "tree_dp": [r"\bsubtree\b", r"\bparent\b", r"\bchildren\b", r"\badj\s*\[", r"\bvector\s*<[^>]+>\s+g\s*\["],
    "digit_dp": [r"\bdigit\b", r"\btight\b", r"\bleading[_ ]?zero"],
    "string_dp": [r"\blcs\b", r"\blps\b", r"\bstring\b", r"\bs1\b", r"\bs2\b"],
}


def labels(cases: list[tuple[str, Column]]) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in cases])) if cases else F.array().cast("array<string>")


def editorial_evidence(editorial: Column) -> Column:
    text = one_line(F.coalesce(editorial, F.lit("")))
    return labels([(p, text.contains(p)) for p in EDITORIAL_PHRASES])


def tag_evidence(tags: Column) -> Column:
    weak = F.array(*map(F.lit, WEAK_TAGS))
    return F.transform(F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.array_contains(weak, t)), lambda t: F.concat(F.lit("tag:"), t))


def needed(pattern: str) -> list[list[str]]:
    """Texts without which a pattern isn't found: one of each list must be there. The lists with long texts come first."""

    def of(items) -> list[list[str]]:
        out, run = [], ""
        for op, value in [*items, (None, None)]:
            if op is _C.LITERAL:
                run += chr(value)
                continue
            if op is _C.AT:  # takes no character
                continue
            out, run = out + [[run]] * bool(run), ""
            if op in (_C.MAX_REPEAT, _C.MIN_REPEAT) and value[0]:
                out += of(value[2])
            elif op is _C.SUBPATTERN:
                out += of(value[3])
            elif op is _C.BRANCH and all(parts := [of(x) for x in value[1]]):
                out.append([t for x in parts for t in max(x, key=_least)])
        return out

    found = sorted({tuple(dict.fromkeys(x)) for x in of(_parser.parse(pattern))}, key=lambda x: (-_least(x), x))
    return [list(x) for x in found]


def _least(texts: list[str] | tuple[str, ...]) -> int:
    return min(map(len, texts))


def folded(text: Column) -> Column:
    """Lower case, for literals of ASCII to be looked for: with the four other characters that a pattern in any case takes for letters of ASCII."""
    for other, letter in (("\u017f", "s"), ("\u0131", "i"), ("\u0130", "i"), ("\u212a", "k")):
        text = F.replace(text, F.lit(other), F.lit(letter))
    return F.lower(text)


def _may_have(text: Column, pattern: str, fold: bool = False) -> Column:
    """Whether a text has what the pattern needs: a search for bytes, a small part of the cost of a pattern with word ends, which looks at each character's kind."""
    lists = [[t.lower() if fold else t for t in x] for x in needed(pattern) if not fold or all(t.isascii() for t in x)]
    return reduce(lambda a, b: a & b, [reduce(lambda a, b: a | b, [text.contains(t) for t in x]) for x in lists], F.lit(True))


def code_signals(flat_code: Column) -> Column:
    """Each pattern is tried on code that has what it needs alone."""
    return labels([(n, F.when(_may_have(flat_code, p), flat_code.rlike(FLAGS + p))) for n, p in CODE_SIGNALS.items()])


def longest_word(pattern: str) -> str | None:
    """The longest word that is in whatever a pattern matches in any case, in lower case; None if there is none. Many patterns share theirs."""
    return max((w for x in needed(pattern) if len(x) == 1 and x[0].isascii() for w in re.findall(r"\w+", x[0].lower())), key=len, default=None)


def categories(text: Column, patterns: dict[str, list[str]], plain: Column | None = None) -> Column:
    """Categories of which any pattern is found, in any case; each is tried on texts that have what it needs alone, which is looked for where its longest word is.

    plain: a column that holds folded(text) already, else each pattern makes it anew.
    """
    plain = folded(text) if plain is None else plain

    def has(p: str) -> Column:  # conditions within each other, since Spark makes what is common to both sides of an "and" for each row
        match = F.when(_may_have(plain, p, fold=True), text.rlike(FLAGS_ANY_CASE + p)).otherwise(False)
        return match if longest_word(p) is None else F.when(plain.contains(longest_word(p)), match).otherwise(False)

    return labels([(n, reduce(lambda a, b: a | b, map(has, ps))) for n, ps in patterns.items()])


def code_counts(code: Column) -> dict[str, Column]:
    """Matches of each category's patterns, summed."""

    count = lambda p: F.when(code.isNull() | _may_have(code, p), F.regexp_count(code, F.lit(FLAGS + p))).otherwise(0)
    return {n: reduce(lambda a, b: a + b, map(count, ps)).cast("long") for n, ps in CODE_COUNTS.items()}
