"""Recognition engines as plug-ins of the page stage.

None of the engines is a dependency: each adapter imports or calls its engine when a worker
builds it, and says what is missing if it isn't there. An adapter turns gray blocks into what
its engine reads, and the engine's answer into one text a block; batches, retries and wrong
answers are the page stage's business.
"""

from __future__ import annotations

import functools
import importlib
import os
import shutil
import subprocess
from typing import Any

import numpy as np

from vellumine.config import tesseract_options
from vellumine.functions.results import harvest
from vellumine.operators import images
from vellumine.operators.pages import RECOGNISERS


def needed(module: str) -> Any:
    """A module of an engine; RuntimeError with its name if it can't be imported."""
    try:
        return importlib.import_module(module)
    except ImportError as problem:
        raise RuntimeError(f"the engine needs {module}, which can't be imported here: {problem}") from problem


def device(preferred: str | None = None) -> str:
    """Where a model runs: as told, as VELLUMINE_DEVICE says, else cuda or mps if torch sees them, else cpu."""
    told = preferred or os.environ.get("VELLUMINE_DEVICE")
    if told:
        return told
    try:
        torch = importlib.import_module("torch")
    except ImportError:
        return "cpu"
    if torch.cuda.is_available():
        return "cuda"
    backends = getattr(torch, "backends", None)
    return "mps" if getattr(backends, "mps", None) and backends.mps.is_available() else "cpu"


def rgb(block: np.ndarray) -> np.ndarray:
    """A gray block with three equal channels."""
    return np.repeat(block[:, :, None], 3, axis=2) if block.ndim == 2 else block


def pgm(block: np.ndarray) -> bytes:
    """A gray block as a binary PGM file."""
    own = np.ascontiguousarray(images.gray(block))
    return b"P5 %d %d 255\n" % (own.shape[1], own.shape[0]) + own.tobytes()


def lines_of(answer: Any, detected: bool) -> list[str]:
    """Lines of a classic answer: [[box, (text, score)], ...], or without detection [(text, score), ...]; see results.classic_text."""
    if isinstance(answer, list) and len(answer) == 1 and isinstance(answer[0], list):
        answer = answer[0]
    out = []
    for item in answer if isinstance(answer, list) else ():
        if not isinstance(item, (list, tuple)) or len(item) < 2:
            continue
        second = item[1]
        if not detected and len(item) == 2 and isinstance(item[0], str):
            out.append(item[0])
        elif isinstance(second, (list, tuple)) and second and isinstance(second[0], str):
            out.append(second[0])
    return [t.strip() for t in out if t.strip()]


def member(x: Any, name: str) -> Any:
    """A member of a mapping or an attribute of an object; None if there is none."""
    return x.get(name) if isinstance(x, dict) else getattr(x, name, None)


def tree_text(page: Any) -> str:
    """Text of a page of blocks of lines of words, as mappings or objects; see results.page_text."""
    blocks = []
    for block in member(page, "blocks") or ():
        lines = [" ".join((member(w, "value") or "").strip() for w in member(line, "words") or ()).strip() for line in member(block, "lines") or ()]
        blocks.append("\n".join(t for t in lines if t))
    return "\n\n".join(b for b in blocks if b)


class Engine:
    """What all adapters share: checked settings and prepared blocks."""

    #: Settings with their types; those in ``required`` must not be empty.
    settings: dict[str, type] = {"preprocess": str}
    required: tuple[str, ...] = ()

    def __init__(self, **given: Any):
        known = {**Engine.settings, **self.settings}
        wrong = [f"unknown setting {k}" for k in given if k not in known]
        wrong += [f"{k} must be {known[k].__name__}" for k, v in given.items() if k in known and v is not None and not isinstance(v, known[k])]
        wrong += [f"{k} is required" for k in self.required if not given.get(k)]
        if given.get("preprocess", "none") not in images.MODES:
            wrong.append(f"preprocess must be one of {', '.join(images.MODES)}")
        if wrong:
            raise ValueError(f"{type(self).__name__}: {'; '.join(wrong)}")
        self.given = given

    def run_blocks(self, blocks: list[np.ndarray]) -> list[str]:
        return [self.read(images.prepared(b, self.given.get("preprocess", "none"))).strip() for b in blocks]

    def read(self, block: np.ndarray) -> str:
        raise NotImplementedError


class TesseractCommand(Engine):
    """The command line program, one call a block, the image on its standard input."""

    settings = {"lang": str, "config": str, "program": str}
    required = ("lang", "config")

    def __init__(self, **given: Any):
        super().__init__(**given)
        psm, oem, variables = tesseract_options(given["config"])
        program = given.get("program") or "tesseract"
        if shutil.which(program) is None:
            raise RuntimeError(f"the engine needs the program {program}")
        self.command = [program, "stdin", "stdout", "-l", given["lang"]]
        self.command += [x for name, v in (("--psm", psm), ("--oem", oem)) if v is not None for x in (name, str(v))]
        self.command += [x for k, v in variables.items() for x in ("-c", f"{k}={v}")]

    def read(self, block: np.ndarray) -> str:
        done = subprocess.run(self.command, input=pgm(block), capture_output=True, check=True)
        return done.stdout.decode("utf-8", "replace")


@functools.lru_cache(maxsize=8)
def _tesserocr(lang: str, oem: int | None, path: str | None) -> Any:
    """One handle a worker for each language, engine mode and data folder."""
    own = {"lang": lang} | ({"oem": oem} if oem is not None else {}) | ({"path": path} if path else {})
    return needed("tesserocr").PyTessBaseAPI(**own)


class TesserocrLibrary(Engine):
    """The same engine as a library, its handle kept for the life of a worker."""

    settings = {"lang": str, "config": str, "data": str}
    required = ("lang",)

    def read(self, block: np.ndarray) -> str:
        psm, oem, variables = tesseract_options(self.given.get("config") or "")
        handle = _tesserocr(self.given["lang"], oem, self.given.get("data") or os.environ.get("TESSDATA_PREFIX"))
        if psm is not None:
            handle.SetPageSegMode(psm)
        for name, value in variables.items():
            handle.SetVariable(name, value)
        own = np.ascontiguousarray(images.gray(block))
        handle.SetImageBytes(own.tobytes(), own.shape[1], own.shape[0], 1, own.shape[1])
        return handle.GetUTF8Text() or ""


class DoctrPredictor(Engine):
    """A page predictor; a block is a page. All blocks of a batch go in one call."""

    settings = {"detection": str, "recognition": str}

    def __init__(self, **given: Any):
        super().__init__(**given)
        own = {k: v for k, v in (("det_arch", given.get("detection")), ("reco_arch", given.get("recognition"))) if v}
        self.predict = needed("doctr.models").ocr_predictor(pretrained=True, **own)

    def run_blocks(self, blocks: list[np.ndarray]) -> list[str]:
        found = self.predict([rgb(images.prepared(b, self.given.get("preprocess", "none"))) for b in blocks])
        return [tree_text(page) for page in member(found, "pages") or ()]


class PaddleReader(Engine):
    """Reads a block without detection, with it if nothing came out, or by predict() where the engine knows no classic call."""

    settings = {"lang": str, "detect": bool, "options": dict}
    required = ("lang",)

    def __init__(self, **given: Any):
        super().__init__(**given)
        self.engine = needed("paddleocr").PaddleOCR(lang=given["lang"], **(given.get("options") or {}))

    def read(self, block: np.ndarray) -> str:
        detect = bool(self.given.get("detect"))
        try:
            lines = lines_of(self.engine.ocr(rgb(block), det=detect, rec=True, cls=False), detect)
            if not lines and not detect:
                lines = lines_of(self.engine.ocr(rgb(block), det=True, rec=True, cls=False), True)
        except TypeError as problem:
            if "unexpected keyword argument" not in str(problem):
                raise
            lines = harvest(self.engine.predict(rgb(block)))
        return "\n".join(lines)


class LinePredictor(Engine):
    """Any predictor (module:factory) that gives an object or mapping with text_lines for each image."""

    settings = {"predictor": str, "languages": list}
    required = ("predictor",)

    def __init__(self, **given: Any):
        super().__init__(**given)
        module, _, name = given["predictor"].partition(":")
        self.predict = getattr(needed(module), name)()

    def run_blocks(self, blocks: list[np.ndarray]) -> list[str]:
        prepared = [rgb(images.prepared(b, self.given.get("preprocess", "none"))) for b in blocks]
        languages = self.given.get("languages")
        try:
            found = self.predict(prepared, langs=[languages] * len(prepared)) if languages else self.predict(prepared)
        except TypeError:  # a version that doesn't take languages
            found = self.predict(prepared)
        return ["\n".join(t for line in member(p, "text_lines") or () if (t := (member(line, "text") or "").strip())) for p in found]


class TextGenerator(Engine):
    """Any generator (module:factory) called with images and one prompt for each; ``header`` is the first block's."""

    settings = {"generator": str, "prompt": str, "header": str, "longest": int}
    required = ("generator", "prompt")

    def __init__(self, **given: Any):
        super().__init__(**given)
        module, _, name = given["generator"].partition(":")
        self.generate = getattr(needed(module), name)()

    def run_blocks(self, blocks: list[np.ndarray]) -> list[str]:
        own = [images.resized(images.prepared(b, self.given.get("preprocess", "none"), images.STRONGER), self.given.get("longest") or 1 << 30) for b in blocks]
        prompts = [self.given.get("header") or self.given["prompt"]] + [self.given["prompt"]] * (len(own) - 1)
        return [(t or "").strip() for t in self.generate([rgb(b) for b in own], prompts)]


RECOGNISERS.update({
    "tesseract": f"{__name__}:TesseractCommand", "tesserocr": f"{__name__}:TesserocrLibrary", "doctr": f"{__name__}:DoctrPredictor",
    "paddle": f"{__name__}:PaddleReader", "lines": f"{__name__}:LinePredictor", "generator": f"{__name__}:TextGenerator",
})
