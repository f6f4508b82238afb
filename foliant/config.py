"""Settings: defaults, a YAML or JSON file over them, the environment over that; and a lock file of what was used."""

from __future__ import annotations

import copy
import hashlib
import json
import os
from collections.abc import Mapping
from pathlib import Path
from typing import Any

#: What holds where nothing else is said.
DEFAULTS: dict[str, Any] = {
    "device": "auto", "dpi": 220, "layout": {"model": "pp_doclayout_l", "conf_threshold": 0.25, "classes": ["Text", "Title", "List", "Table", "Figure"]}, "ocr": {"lang": "ml"}, "langid": {"model_path": ".cache/lid.176.bin"},
    "vlm": {"model": "Qwen/Qwen2-VL-7B-Instruct"}, "describe": {"batch_size": 2}, "io": {"cache_dir": ".cache", "debug_dir": "./debug"}, "runtime": {"num_workers": 4},
    "paths": {"weights_dir": "./weights", "runs_dir": "./runs", "debug_dir": "./debug", "cache_dir": "./.cache"},
}
#: Settings that the environment may change, as FOLIANT_ and the path in capitals; and the types of those that are not text.
FROM_ENVIRONMENT = ("device", "dpi", "layout.model", "layout.conf_threshold", "ocr.lang", "langid.model_path", "vlm.model", "describe.batch_size", "io.cache_dir", "io.debug_dir", "runtime.num_workers")
TYPES = {"dpi": int, "layout.conf_threshold": float, "describe.batch_size": int, "runtime.num_workers": int}
#: What a lock file holds beside settings, by section.
LOCKED: dict[str, dict[str, Any]] = {
    "training": {"weight_decay": 0.0005, "momentum": 0.937, "warmup_epochs": 3, "warmup_momentum": 0.8, "warmup_bias_lr": 0.1},
    "detection": {"max_det": 300, "agnostic_nms": False},
    "seeds": {"python_hash_seed": 0, "numpy_seed": 42, "torch_seed": 42, "paddle_seed": 42, "random_seed": 42},
}


def merged(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """base with over's entries; where both have a mapping the two are merged in turn. Neither is changed."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(out.get(k), Mapping) and isinstance(v, Mapping) else v
    return out


def set_path(config: dict[str, Any], path: str, value: Any) -> None:
    """config["a"]["b"] = value for the path a.b; missing mappings are made."""
    *above, last = path.split(".")
    for k in above:
        config = config.setdefault(k, {})
    config[last] = value


def get_path(config: Mapping[str, Any], path: str, default: Any = None) -> Any:
    for k in path.split("."):
        if not isinstance(config, Mapping) or k not in config:
            return default
        config = config[k]
    return config


def read_settings(path: str | Path) -> dict[str, Any]:
    """A JSON or YAML file; {} for an empty one."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return json.loads(text or "{}")
    import yaml

    return yaml.safe_load(text) or {}


def load(path: str | Path | None = None, environment: Mapping[str, str] | None = None) -> dict[str, Any]:
    """Defaults, then the file if it is there, then the environment. Numbers given as text become numbers; device auto
    becomes cpu: Spark's executors are what runs."""
    config = copy.deepcopy(DEFAULTS)
    if path is not None and Path(path).exists():
        config = merged(config, read_settings(path))
    environment = os.environ if environment is None else environment
    for setting in FROM_ENVIRONMENT:
        value = environment.get("FOLIANT_" + setting.replace(".", "_").upper())
        if value is not None:
            set_path(config, setting, value)
    for setting, kind in TYPES.items():
        if isinstance(value := get_path(config, setting), str):
            set_path(config, setting, kind(value))
    if config["device"] == "auto":
        config["device"] = "cpu"
    return config


def lock(config: Mapping[str, Any]) -> tuple[str, str]:
    """(text, SHA-256 of it) of what a run used: settings by section with the fixed values beside them."""
    out = copy.deepcopy(LOCKED)
    out["dataset"] = {"classes": get_path(config, "layout.classes", DEFAULTS["layout"]["classes"]), "imgsz": get_path(config, "train.imgsz", 960), "schema": "yolo"}
    out["detection"] |= {"conf_thr": get_path(config, "train.conf_thr", 0.25), "iou_nms": get_path(config, "train.iou_nms", 0.5)}
    out["environment"] = {"device": config.get("device", "auto"), "num_workers": get_path(config, "runtime.num_workers", 4), "deterministic": True}
    text = json.dumps(out, indent=2, sort_keys=True) + "\n"
    return text, hashlib.sha256(text.encode()).hexdigest()


def write_lock(config: Mapping[str, Any], path: str | Path) -> str:
    """Writes the lock file and its hash beside it; the hash comes back."""
    text, digest = lock(config)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text, encoding="utf-8")
    Path(f"{path}.sha256").write_text(f"{digest}\n", encoding="utf-8")
    return digest


def id_names(text: str, classes: list[str] | None = None) -> dict[int, str]:
    """{1: "Text", 2: "Title"} of "1:Text 2:Title" or "1:Text,2:Title"; with classes, a name outside them is an error."""
    out = {}
    for part in text.replace(",", " ").split():
        number, name = part.split(":", 1)
        out[int(number)] = name.strip()
    wrong = sorted(set(out.values()) - set(classes or out.values()))
    if wrong:
        raise ValueError(f"unknown class {wrong[0]}; one of {', '.join(classes or [])} is needed")
    return out


def page_range(text: str | None) -> tuple[int, int | None]:
    """(start, stop) of "0-10", "3-" or "3" (that page alone); everything without a text."""
    if not text:
        return 0, None
    start, dash, stop = text.partition("-")
    return int(start or 0), int(stop) if stop else (None if dash else int(start) + 1)
