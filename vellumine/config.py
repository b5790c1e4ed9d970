"""Settings: one table drives defaults, checks, routing of overrides and profile files."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path
from types import MappingProxyType
from typing import Any, Mapping

SECTIONS = ("engine", "strategy", "extraction")


@dataclass(frozen=True)
class Setting:
    """A setting's section, default and allowed values.

    least and most bound numbers (above: the least itself isn't allowed); choices list the
    allowed values. A setting whose default is None, or that is optional, may be None.
    """

    section: str
    default: Any
    least: float | None = None
    most: float | None = None
    above: bool = False
    choices: tuple = ()
    optional: bool = False

    def problem(self, value: Any) -> str | None:
        """What is wrong with a value, or None."""
        if value is None:
            return None if self.optional or self.default is None else "must have a value"
        if self.choices and value not in self.choices:
            return f"must be one of {', '.join(map(str, self.choices))}"
        if isinstance(self.default, bool) and not isinstance(value, bool):
            return "must be true or false"
        if self.least is None and self.most is None:
            return None
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            return "must be a number"
        if self.least is not None and (value <= self.least if self.above else value < self.least):
            return f"must be {'above' if self.above else 'at least'} {self.least:g}"
        if self.most is not None and value > self.most:
            return f"must be at most {self.most:g}"
        return None


# Names, defaults, bounds and choices of all settings.
SETTINGS: Mapping[str, Setting] = MappingProxyType({
    "enable_prefix_caching": Setting("engine", False),
    "tensor_parallel_size": Setting("engine", 1, least=1),
    "gpu_memory_utilization": Setting("engine", 0.9, least=0, most=1, above=True),
    "max_model_len": Setting("engine", None, least=1),
    "swap_space": Setting("engine", 4.0, least=0),
    "enforce_eager": Setting("engine", False),
    "doc_batch_size": Setting("engine", 32, least=1, optional=True),
    "sort_by_prompt_length": Setting("engine", True),
    "tokenizer_mode": Setting("engine", "auto", choices=("auto", "mistral")),
    "quantization": Setting("engine", "none"),
    "name": Setting("strategy", "baseline", choices=("baseline", "chunked", "header_first", "two_pass_targeted", "self_consistency")),
    "extraction_mode": Setting("strategy", "auto", choices=("auto", "single", "chunked")),
    "chunk_size_chars": Setting("strategy", 7_000, least=1),
    "chunk_overlap_chars": Setting("strategy", 800, least=0),
    "extraction_passes": Setting("strategy", 2, least=1),
    "header_lines": Setting("strategy", 30, least=1),
    "targeted_rerun_threshold": Setting("strategy", 0.6, least=0, most=1),
    "self_consistency_n": Setting("strategy", 2, least=1),
    "self_consistency_temp": Setting("strategy", 0.2, least=0),
    "merge_policy": Setting("strategy", "prefer_non_null", choices=("prefer_first", "prefer_last", "prefer_non_null", "vote_majority")),
    "model_name": Setting("extraction", "mistralai/Mistral-Small-3.1-24B-Instruct-2503"),
    "torch_dtype": Setting("extraction", "auto", choices=("auto", "bf16", "fp16", "fp32")),
    "prompt_id": Setting("extraction", None),
    "prompt_path": Setting("extraction", None),
    "guardrail_profile": Setting("extraction", "auto", choices=("auto", "off", "de_legacy_self_applicant")),
    "max_ocr_chars": Setting("extraction", 10_000, least=1),
    "max_new_tokens": Setting("extraction", 1_024, least=1),
    "temperature": Setting("extraction", 0.0, least=0),
    "do_sample": Setting("extraction", False),
    "save_strategy_meta": Setting("extraction", False),
    "save_raw_output": Setting("extraction", False),
    "timings": Setting("extraction", "basic", choices=("off", "basic", "detailed")),
})
#: The prompt for which the self-applicant rule applies by default; fixed value.
GUARDED_PROMPT = "v4"


class Profile:
    """Values of all settings, read as attributes; immutable.

    Settings that aren't given have their defaults. Unknown settings and values out of
    bounds raise ValueError, all of them in one message.
    """

    def __init__(self, **values: Any):
        if "strategy" in values:  # as overrides name it
            values["name"] = values.pop("strategy")
        wrong = [f"unknown setting {k!r}" for k in values if k not in SETTINGS]
        held = {k: values.get(k, s.default) for k, s in SETTINGS.items()}
        wrong += [f"{k} {p}" for k, s in SETTINGS.items() if (p := s.problem(held[k]))]
        if not wrong and held["chunk_overlap_chars"] >= held["chunk_size_chars"]:
            wrong.append("chunk_overlap_chars must be less than chunk_size_chars")
        if wrong:
            raise ValueError("; ".join(wrong))
        object.__setattr__(self, "_held", MappingProxyType(held))

    def __getattr__(self, key: str) -> Any:
        if key.startswith("_") or key not in SETTINGS:
            raise AttributeError(key)
        return self._held[key]

    def __setattr__(self, key: str, value: Any) -> None:
        raise AttributeError(f"{key} can't be set; use overridden")

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Profile) and dict(self._held) == dict(other._held)

    def __hash__(self) -> int:
        return hash(tuple(map(str, self._held.items())))

    def section(self, name: str) -> dict[str, Any]:
        """The settings of one section."""
        return {k: v for k, v in self._held.items() if SETTINGS[k].section == name}

    def as_dict(self) -> dict[str, dict[str, Any]]:
        """All settings by section."""
        return {s: self.section(s) for s in SECTIONS}

    def guarded(self) -> bool:
        """Whether the self-applicant rule applies."""
        return self.guardrail_profile == "de_legacy_self_applicant" or self.guardrail_profile == "auto" and self.prompt_id == GUARDED_PROMPT


def overridden(profile: Profile, **changes: Any) -> Profile:
    """The profile with changes; None is no change. ``strategy`` is the strategy's name."""
    return Profile(**{**profile._held, **{("name" if k == "strategy" else k): v for k, v in changes.items() if v is not None}})


def load_profile(path: str | Path) -> Profile:
    """A profile from a JSON file of settings, flat or by section; missing ones have their defaults.

    A section that is one word is the strategy's name.
    """
    path = Path(path)
    if not path.exists():
        raise FileNotFoundError(f"no profile {path}")
    given: dict[str, Any] = {}
    for key, value in json.loads(path.read_text(encoding="utf-8")).items():
        given.update(value if key in SECTIONS and isinstance(value, dict) else {key: value})
    return Profile(**given)


def prompt_path(profile_path: str | Path, explicit: str | None = None, resource: str | None = None, resources: str | Path = ".", relative: str | None = None) -> Path | None:
    """The prompt's file: the explicit one, else a resource of the library, else one beside the profile; None without any.

    The last two must exist.
    """
    if explicit:
        return Path(explicit).expanduser().resolve()
    found = Path(resources) / resource if resource else Path(profile_path).parent / relative if relative else None
    if found is not None and not found.exists():
        raise FileNotFoundError(f"no prompt {found}")
    return found.resolve() if found is not None else None


def timings_kept(profile: "Profile", times: Mapping[str, tuple[float | None, float | None]]) -> dict[str, float]:
    """Durations of begin and end times at the profile's level: none, total and generate, or all; never negative."""
    wanted = {"off": (), "basic": ("t_total_s", "t_generate_s"), "detailed": tuple(times)}[profile.timings]
    return {k: max(0.0, b - a) for k, (a, b) in times.items() if k in wanted and a is not None and b is not None}


def flags(line: list[str]) -> dict[str, Any]:
    """Overrides from arguments like --chunk-size-chars 5 and the pairs --x and --no-x; what isn't named isn't in it.

    >>> flags(["--strategy", "chunked", "--no-do-sample", "--temperature", "0.5"])
    {'strategy': 'chunked', 'do_sample': False, 'temperature': 0.5}
    """
    out: dict[str, Any] = {}
    words = iter(line)
    for word in words:
        key = word.removeprefix("--").replace("-", "_")
        name = key.removeprefix("no_")
        if isinstance(SETTINGS.get(name, Setting("", None)).default, bool):
            out[name] = key == name
            continue
        if not word.startswith("--") or key not in SETTINGS and key != "strategy":
            raise ValueError(f"unknown argument {word!r}")
        value = next(words, None)
        if value is None:
            raise ValueError(f"{word} needs a value")
        kind = type(SETTINGS["name" if key == "strategy" else key].default)
        out[key] = kind(value) if kind in (int, float) else value
    return out


def tesseract_options(line: str) -> tuple[int | None, int | None, dict[str, str]]:
    """Page mode, engine mode and variables of a command line like "--psm 6 -c a=b".

    >>> tesseract_options("--psm 6 --oem=1 -c preserve_interword_spaces=1")
    (6, 1, {'preserve_interword_spaces': '1'})
    """
    modes: dict[str, int | None] = {"--psm": None, "--oem": None}
    variables: dict[str, str] = {}
    words = iter(line.split())
    for word in words:
        name, given, value = word.partition("=")
        if name in modes:
            value = value if given else next(words, "")
            if not value:
                raise ValueError(f"{name} needs a value")
            modes[name] = int(value)
        elif word == "-c":
            key, given, value = next(words, "").partition("=")
            if not given:
                raise ValueError("-c needs name=value")
            variables[key] = value
        else:
            raise ValueError(f"unknown option {word!r}")
    return modes["--psm"], modes["--oem"], variables
