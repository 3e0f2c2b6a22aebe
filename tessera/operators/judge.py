"""Judging solutions by running them: opt-in, in worker processes.

Programs are untrusted. Compilers, programs and checkers all run with limits on memory, file size and processes, each in a
session of its own that is killed as a whole when time is up, in a folder that is removed afterwards. Nothing here isolates the
network or the file system: run it on executors that are made for it. A task that is tried again runs its programs again, so results are
keyed by (problem_id, source_id).
"""

from __future__ import annotations

import contextlib
import os
import resource
import select
import selectors
import shutil
import signal
import subprocess
import sys
import tempfile
import time
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ANY_CASE, any_case
from ..sources.schemas import RESULT

#: Compiler flags by compiler; languages by the parts of their names, in order.
STANDARDS = {"cpp": "gnu++17", "cpp11": "gnu++11", "cpp14": "gnu++14", "cpp17": "gnu++17", "cpp20": "gnu++20"}
COMPILERS = {"pypy": "pypy", "python": "python", "c++20": "cpp20", "c++17": "cpp17", "c++14": "cpp14", "c++11": "cpp11", "c++": "cpp"}
ACCEPTED, REJECTED = ("1", "100"), ("0",)
COMPILE_SECONDS, CHECK_SECONDS, LEAST_SECONDS = 60.0, 5.0, 2.0
ERROR_TAIL, OUTPUT_TAIL = 4000, 2000
#: What a program may print: beyond it the program is ended, as limits on files don't bind pipes.
MOST_OUTPUT = 64 << 20
COLUMNS = [c.split()[0] for c in RESULT.split(", ")]


@dataclass(frozen=True)
class Limits:
    memory: int = 2 << 30
    file: int = 64 << 20
    processes: int = 64

    def apply(self) -> None:
        for what, most in ((resource.RLIMIT_AS, self.memory), (resource.RLIMIT_FSIZE, self.file), (resource.RLIMIT_NPROC, self.processes)):
            hard = resource.getrlimit(what)[1]
            most = most if hard == resource.RLIM_INFINITY else min(most, hard)
            resource.setrlimit(what, (most, most))


@dataclass(frozen=True)
class Ran:
    code: int | None  # None: out of time
    out: str
    err: str
    ms: float


def _kill(process: subprocess.Popen) -> None:
    with contextlib.suppress(ProcessLookupError):
        os.killpg(process.pid, signal.SIGKILL)


def run(command: list[str], folder: Path, data: str, seconds: float, limits: Limits | None, most: int = MOST_OUTPUT) -> Ran:
    """Runs a program on some input. A program that is out of time, or has printed more than ``most`` bytes, is ended: the first has no code, the other one above 0."""
    began = time.perf_counter()
    ms = lambda: (time.perf_counter() - began) * 1000
    try:
        process = subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE, cwd=folder, start_new_session=True, preexec_fn=limits.apply if limits else None)
    except (OSError, subprocess.SubprocessError) as e:
        return Ran(-1, "", str(e), ms())
    rest, got, too_much = memoryview(data.encode("utf-8", "surrogatepass")), {process.stdout: bytearray(), process.stderr: bytearray()}, False
    with selectors.DefaultSelector() as ready:
        for pipe in got:
            ready.register(pipe, selectors.EVENT_READ)
        if rest:
            ready.register(process.stdin, selectors.EVENT_WRITE)
        else:
            process.stdin.close()
        while len(ready.get_map()) and not too_much and (left := began + seconds - time.perf_counter()) > 0:
            for key, _ in ready.select(left):
                pipe = key.fileobj
                if pipe is process.stdin:
                    try:
                        rest = rest[os.write(pipe.fileno(), rest[: select.PIPE_BUF]) :]
                    except BrokenPipeError:
                        rest = rest[:0]
                    if not rest:
                        ready.unregister(pipe)
                        pipe.close()
                elif part := os.read(pipe.fileno(), 1 << 16):
                    got[pipe] += part
                    too_much = sum(map(len, got.values())) > most
                else:
                    ready.unregister(pipe)
    code: int | None = None
    if not too_much:
        with contextlib.suppress(subprocess.TimeoutExpired):
            code = process.wait(max(0.0, began + seconds - time.perf_counter()))
    _kill(process)
    process.wait()
    for pipe in (process.stdin, process.stdout, process.stderr):
        with contextlib.suppress(OSError):
            pipe.close()
    out, err = (bytes(x).decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n") for x in got.values())
    return Ran(1 if too_much else code, out, err + ("\nOutput limit exceeded" if too_much else ""), ms())


def compiler_of(language: str) -> str | None:
    return next((c for part, c in COMPILERS.items() if part in language.lower()), None)


def prepare(source: str, compiler: str, folder: Path, limits: Limits | None) -> tuple[list[str] | None, str]:
    """The command that runs a program, or None and the compiler's message."""
    if compiler in ("python", "pypy"):
        (folder / "main.py").write_text(source, encoding="utf-8")
        return [sys.executable if compiler == "python" else "pypy3", str(folder / "main.py")], ""
    (folder / "main.cpp").write_text(source, encoding="utf-8")
    wide = Limits(memory=8 << 30, file=1 << 30, processes=4096) if limits else None
    ran = run(["g++", f"-std={STANDARDS[compiler]}", "-O2", "-pipe", "-DONLINE_JUDGE", "main.cpp", "-o", "main"], folder, "", COMPILE_SECONDS, wide)
    if ran.code is None:
        return None, "Compilation timeout"
    return (None, ran.err[-ERROR_TAIL:]) if ran.code else ([str(folder / "main")], "")


def same_tokens(actual: str, expected: str, fold: bool) -> bool:
    a, b = actual.split(), expected.split()
    return [x.lower() for x in a] == [x.lower() for x in b] if fold else a == b


def check(checker: str, data: str, reference: str, output: str, limits: Limits | None, seconds: float = CHECK_SECONDS) -> tuple[str, str, str]:
    """PASS, FAIL, CHECKER_ERROR or CHECKER_TLE, and what the checker wrote."""
    with tempfile.TemporaryDirectory(prefix="checker-") as name:
        folder = Path(name)
        for file, text in (("input.txt", data), ("reference.txt", reference), ("submission.txt", output), ("checker.py", checker)):
            (folder / file).write_text(text, encoding="utf-8")
        ran = run([sys.executable, *(str(folder / f) for f in ("checker.py", "input.txt", "reference.txt", "submission.txt"))], folder, "", seconds, limits)
    if ran.code is None:
        return "CHECKER_TLE", ran.out, ran.err
    said = ran.out.strip()
    if ran.code == 0 and said in ACCEPTED:
        return "PASS", ran.out, ran.err
    if ran.code == 0 and said in REJECTED:
        return "FAIL", ran.out, ran.err
    return "CHECKER_ERROR", ran.out, ran.err if ran.code else f"{ran.err}\nUnexpected checker output: {said!r}"


def judge(solution: dict, problem: dict, limits: Limits | None = Limits(), pypy: bool | None = None) -> dict:
    """The outcome of one solution: the first test that fails ends it."""
    compiler = compiler_of(solution["language"] or "")
    tests = problem.get("official_tests")
    tests = [] if tests is None else list(tests)
    done = {"tests_passed": 0, "tests_total": 0}
    if compiler is None:
        return {"status": "UNSUPPORTED_LANGUAGE", **done}
    if compiler == "pypy" and not (shutil.which("pypy3") if pypy is None else pypy):
        return {"status": "PYTHON_INTERPRETER_UNAVAILABLE", **done}
    with tempfile.TemporaryDirectory(prefix="judge-") as name:
        command, message = prepare(solution["source_code"] or "", compiler, Path(name), limits)
        if command is None:
            missing = "No such file or directory" in message or "file not found" in message.lower()
            return {"status": "UNSUPPORTED_DEPENDENCY" if missing else "CE", "compile_error": message, **done}
        if not tests:
            return {"status": "UNVERIFIED", **done}
        limit = problem.get("time_limit")
        seconds = max(LEAST_SECONDS, 2 * float(LEAST_SECONDS if limit is None else limit))
        checker, fold = problem.get("generated_checker"), any(p in (problem.get("output_format") or "").lower() for p in ANY_CASE)
        times: list[float] = []
        for passed, test in enumerate(tests):
            data = (test["input"] or "").replace("\r\n", "\n").replace("\r", "\n")
            ran = run(command, Path(name), data, seconds, limits)
            times.append(ran.ms)
            so_far = {"tests_passed": passed, "tests_total": len(tests)}
            own = {"stdout": ran.out[-OUTPUT_TAIL:], "stderr": ran.err[-OUTPUT_TAIL:], "execution_time_ms": ran.ms}
            if ran.code != 0:
                return {"status": "TLE" if ran.code is None else "RE", **so_far, **own}
            if checker:
                verdict, out, err = check(checker, test["input"] or "", test["output"] or "", ran.out, limits)
                theirs = {"checker_stdout": out[-OUTPUT_TAIL:], "checker_stderr": err[-OUTPUT_TAIL:]}
                if verdict == "FAIL":
                    return {"status": "WRONG_ANSWER", **so_far, **theirs, "stdout": own["stdout"], "execution_time_ms": ran.ms}
                if verdict != "PASS":
                    return {"status": verdict, **so_far, **theirs}
            elif not same_tokens(ran.out, test["output"] or "", fold):
                return {"status": "WRONG_ANSWER", **so_far, **own}
        complete = bool(problem.get("official_tests_complete") or False)
        return {
            "status": "PASSED_CHECKER" if checker else "PASSED_EXACT" if complete else "PASSED_AVAILABLE_TESTS", "tests_passed": len(tests), "tests_total": len(tests),
            "max_execution_time_ms": max(times), "total_execution_time_ms": sum(times), "official_tests_complete": complete, "used_generated_checker": bool(checker),
        }


def eligible_problems(problems: DataFrame, solutions: DataFrame) -> DataFrame:
    """Problems over standard input with tests that can be run and have solutions."""
    can = problems.where((F.col("input_mode") == "stdio") & (F.size("official_tests") > 0) & F.coalesce("executable", F.lit(False)))
    return can.join(solutions.select(F.col("problem_id").alias("id")).distinct(), "id", "left_semi")


def verify(solutions: DataFrame, problems: DataFrame, limits: Limits | None = Limits(), tasks: int | None = None) -> DataFrame:
    """One row a solution, with its outcome. The tests travel with each solution; solutions are dealt evenly over ``tasks``."""
    facts = problems.select(F.col("id").alias("problem_id"), F.struct("official_tests", "time_limit", "generated_checker", "output_format", "official_tests_complete").alias("problem_"))
    rows = solutions.join(facts, "problem_id").select("problem_id", "source_id", "language", "verdict", "source", "source_code", "problem_")
    rows = rows.repartition(tasks or int(solutions.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                out.append(row | judge(row, row.pop("problem_"), limits))
            yield pd.DataFrame(out, columns=COLUMNS).astype(object).where(lambda d: d.notna(), None)

    return rows.mapInPandas(one, RESULT)


def result_counts(results: DataFrame, column: str = "status") -> DataFrame:
    return results.groupBy(column).count().orderBy(F.desc("count"), column)


__all__ = ["Limits", "any_case", "check", "eligible_problems", "judge", "prepare", "result_counts", "run", "verify"]
