"""Adapters of engines against stand-ins of the engines."""

import sys
import types

import numpy as np
import pytest

from vellumine.operators import engines, pages

BLOCK = np.full((4, 6), 200, dtype=np.uint8)


def stand_in(monkeypatch, name, **members):
    module = types.ModuleType(name)
    for k, v in members.items():
        setattr(module, k, v)
    monkeypatch.setitem(sys.modules, name, module)
    return module


def test_settings_are_checked():
    for wrong in ({}, {"lang": "deu"}, {"lang": 1, "config": "--psm 6"}, {"lang": "deu", "config": "--psm 6", "odd": 1}, {"lang": "deu", "config": "x"}, {"lang": "deu", "config": "--psm 6", "preprocess": "odd"}):
        with pytest.raises(ValueError):
            engines.TesseractCommand(**wrong)
    with pytest.raises(RuntimeError, match="program"):
        engines.TesseractCommand(lang="deu", config="--psm 6", program="no-such-program")
    with pytest.raises(RuntimeError, match="paddleocr"):
        engines.PaddleReader(lang="de")
    assert pages.plug_in("tesseract") is engines.TesseractCommand and engines.device("cuda:1") == "cuda:1"


def test_device(monkeypatch):
    monkeypatch.setenv("VELLUMINE_DEVICE", "mps")
    assert engines.device() == "mps"
    monkeypatch.delenv("VELLUMINE_DEVICE")
    stand_in(monkeypatch, "torch", cuda=types.SimpleNamespace(is_available=lambda: True))
    assert engines.device() == "cuda"


def test_command(tmp_path):
    program = tmp_path / "reader"
    program.write_text('#!/bin/sh\nwc -c | tr -d " \\n"\necho " $@"\n')
    program.chmod(0o755)
    engine = engines.TesseractCommand(lang="deu+fra", config="--psm 6 -c a=b", program=str(program), preprocess="gray")
    assert engine.run_blocks([BLOCK, BLOCK]) == [f"{len(engines.pgm(BLOCK))} stdin stdout -l deu+fra --psm 6 -c a=b"] * 2


def test_libraries(monkeypatch):
    class Handle:
        built = 0

        def __init__(self, **own):
            Handle.built += 1
            self.own, self.mode = own, None

        def SetPageSegMode(self, mode):
            self.mode = mode

        def SetVariable(self, name, value):
            self.own[name] = value

        def SetImageBytes(self, data, width, height, channels, stride):
            self.size = len(data), width, height

        def GetUTF8Text(self):
            return f"{self.own['lang']} {self.mode} {self.size}\n"

    stand_in(monkeypatch, "tesserocr", PyTessBaseAPI=Handle)
    engine = engines.TesserocrLibrary(lang="frk", config="--psm 4")
    assert engine.run_blocks([BLOCK, BLOCK]) == ["frk 4 (24, 6, 4)"] * 2 and Handle.built == 1

    page = {"blocks": [{"lines": [{"words": [{"value": " a"}, {"value": None}]}, {"words": []}]}, {"lines": []}, {"lines": [{"words": [{"value": "b"}]}]}]}
    stand_in(monkeypatch, "doctr")
    stand_in(monkeypatch, "doctr.models", ocr_predictor=lambda pretrained, **own: lambda blocks: types.SimpleNamespace(pages=[page] * len(blocks)))
    assert engines.DoctrPredictor(detection="x").run_blocks([BLOCK]) == ["a\n\nb"]

    class Classic:
        def __init__(self, lang, **own):
            self.empty = own.get("empty")

        def ocr(self, image, det, rec, cls):
            return [[[[0, 0], ("line ", 0.9)]]] if det else [] if self.empty else [("plain", 0.5), (" ", 1)]

    class New(Classic):
        ocr = None

        def predict(self, image):
            return [{"rec_texts": ["x"]}]

    stand_in(monkeypatch, "paddleocr", PaddleOCR=Classic)
    assert engines.PaddleReader(lang="de").run_blocks([BLOCK]) == ["plain"] and engines.PaddleReader(lang="de", options={"empty": True}).run_blocks([BLOCK]) == ["line"]
    New.ocr = lambda self, image: None
    stand_in(monkeypatch, "paddleocr", PaddleOCR=New)
    assert engines.PaddleReader(lang="de").run_blocks([BLOCK]) == ["x\nx"]

    stand_in(monkeypatch, "some", lines=lambda: lambda blocks: [{"text_lines": [{"text": " t "}, None, {"text": None}]} for _ in blocks], texts=lambda: lambda blocks, prompts: [f"{b.shape} {p}" for b, p in zip(blocks, prompts)])
    assert engines.LinePredictor(predictor="some:lines", languages=["de"]).run_blocks([BLOCK]) == ["t"]
    assert engines.TextGenerator(generator="some:texts", prompt="P", header="H", longest=3).run_blocks([BLOCK, BLOCK]) == ["(2, 3, 3) H", "(2, 3, 3) P"]
    assert engines.lines_of(None, True) == [] and engines.lines_of([[1]], False) == []
