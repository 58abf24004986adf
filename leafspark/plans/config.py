"""Settings of a book: defaults, a TOML file, options given by the user, branch overrides, profiles and hashes."""

from __future__ import annotations

import hashlib
import tomllib
from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class Config:
    ink_hue: float = 5
    ink_hue_range: float = 15
    ink_sat_min: float = 40
    ink_val_min: float = 80
    ink_diff: float = 30
    fingers_detected: bool = False
    stitch_min_matches: int = 30
    stitch_ratio: float = 0.75
    stitch_min_overlap: float = 0.15
    stitch_min_inliers: float = 0.5
    retake_overlap: float = 0.9
    stitch_groups: tuple[tuple[str, ...], ...] = ()
    exclude: tuple[str, ...] = ()
    no_stitch: tuple[str, ...] = ()
    include_covers: bool = False
    page_method: str = "auto"
    page_min_area: float = 0.30
    page_expand: float = 0.05
    border_refinement: bool = True
    border_confidence: float = 0.5
    crop_margin: float = 0.03
    content_inset: float = 0.05
    content_padding: float = 0.0
    content_feather: float = 20
    perspective_max_skew: float = 5
    perspective_max_crop: float = 0.30
    perspective_near_rect: float = 2.0
    perspective_max_tilt: float = 1.5
    deskew_max_angle: float = 5.0
    deskew_step: float = 0.1
    deskew_skip_below: float = 0.1
    split_spreads: bool = False
    dewarp: bool = False
    enhance: tuple[str, ...] = ()
    normalize: bool = False
    pdf_dpi: int = 300
    pdf_compression: str = "jpeg"
    pdf_jpeg_quality: int = 90
    flipbook_max_width: int = 1600
    flipbook_jpeg_quality: int = 85
    flipbook_title: str = ""
    lens_k1: float = 0.0
    lens_k2: float = 0.0
    profile: str = "full"
    preview: int = 0
    on_error: str = "skip"
    skip: tuple[str, ...] = ()
    branches: dict[str, dict] = field(default_factory=dict)

    def ink(self) -> dict:
        return {"hue": self.ink_hue, "reach": self.ink_hue_range, "sat_min": self.ink_sat_min, "val_min": self.ink_val_min, "diff": self.ink_diff}

    def for_branch(self, branch: str) -> Config:
        """This configuration with a branch's overrides."""
        return replace(self, **self.branches.get(branch, {}))


#: Stages that a profile leaves out; mandatory stages always run.
PROFILES = {
    "full": (), "geometry": ("preprocess", "stitch"), "book-only": ("content_area", "staff_extract", "omr", "score_render"),
    "scores-only": ("deskew_book", "perspective"),
}
MANDATORY = ("orientation", "page_detect", "gentle_crop", "perspective", "pdf")
INK = ("ink_hue", "ink_hue_range", "ink_sat_min", "ink_val_min", "ink_diff")
#: Settings that each stage reads; a change to one makes the stage and those after it stale.
READS = {
    "preprocess": ("fingers_detected", *INK),
    "stitch": ("stitch_min_matches", "stitch_ratio", "stitch_min_overlap", "stitch_min_inliers", "retake_overlap", "stitch_groups", "exclude", "no_stitch", "include_covers"),
    "orientation": INK, "lens_correct": ("lens_k1", "lens_k2"),
    "page_detect": ("page_method", "page_min_area", "page_expand", "border_refinement", "border_confidence", *INK),
    "gentle_crop": ("crop_margin",), "content_area": ("content_inset", "content_padding", "content_feather", *INK),
    "staff_extract": INK, "deskew": ("deskew_max_angle", "deskew_step", "deskew_skip_below", *INK),
    "perspective": ("perspective_max_skew", "perspective_max_crop", "perspective_near_rect", "perspective_max_tilt"),
    "dewarp": ("dewarp", *INK), "enhance": ("enhance",), "normalize": ("normalize",), "split": ("split_spreads",),
}
#: Sections of the file, and the prefix of their settings.
SECTIONS = {"ink": "ink_", "stitch": "stitch_", "page_detect": "page_", "gentle_crop": "crop_", "content_area": "content_",
            "perspective": "perspective_", "deskew": "deskew_", "pdf": "pdf_", "flipbook": "flipbook_", "lens": "lens_", "pipeline": ""}
# Names that settings files in use have for some settings.
ALIASES = {
    "angle_max": "deskew_max_angle", "angle_step": "deskew_step", "skip_threshold": "deskew_skip_below", "no_stitch_pages": "no_stitch",
    "staff_color_hue": "ink_hue", "staff_color_range": "ink_hue_range", "staff_saturation_min": "ink_sat_min", "staff_value_min": "ink_val_min",
    "channel_diff_rg": "ink_diff", "ratio_threshold": "stitch_ratio", "min_overlap_frac": "stitch_min_overlap", "inlier_ratio": "stitch_min_inliers",
    "retake_overlap_threshold": "retake_overlap", "min_area_frac": "page_min_area", "expand_frac": "page_expand",
    "border_confidence_threshold": "border_confidence", "margin_frac": "crop_margin", "inset_fallback": "content_inset",
    "margin_padding": "content_padding", "feather_sigma": "content_feather", "max_skew_deg": "perspective_max_skew",
    "max_crop_frac": "perspective_max_crop", "near_rect_threshold_deg": "perspective_near_rect", "max_tilt_deg": "perspective_max_tilt",
    "lens_distortion_k1": "lens_k1", "lens_distortion_k2": "lens_k2",
}
#: Sections that only describe a book, or belong to stages that are not part of this engine; their keys are left alone.
DESCRIPTIVE = ("layout", "condition", "ocr", "omr", "photography")


#: Steps of enhancement by the names of their switches.
STEPS = {"white_balance": "white_balance", "illumination_normalization": "flat_background", "clahe": "local_contrast",
         "denoise": "denoise", "sharpen": "sharpen", "color_cast_correction": "white_balance"}


def _named(section: str, values: dict) -> tuple[dict, list[str]]:
    known, out, odd = {f.name for f in fields(Config)} - {"branches"}, {}, []
    for key, value in values.items():
        name = next((n for n in (SECTIONS.get(section, "") + key, ALIASES.get(key, ""), key) if n in known), None)
        if section == "pipeline" and key.startswith("skip_"):
            out["skip"] = (*out.get("skip", ()), *[key.removeprefix("skip_")] * bool(value))
        elif section == "enhance" and isinstance(value, bool):
            out["enhance"] = (*out.get("enhance", ()), *[STEPS[key]] * (value and key in STEPS))
        elif name is None and section in DESCRIPTIVE:
            continue
        elif name is None:
            odd.append(f"{section}.{key}")
        else:
            out[name] = tuple(tuple(v) if isinstance(v, list) else v for v in value) if isinstance(value, list) else value
    return out, odd


def load(text: str | None, **given) -> tuple[Config, list[str]]:
    """Configuration and unknown keys: options given by the user win over the file, the file over defaults.

    Options that are None count as not given.
    """
    values: dict = {}
    odd: list[str] = []
    branches: dict[str, dict] = {}
    for section, body in (tomllib.loads(text) if text else {}).items():
        if section in ("book", "score") and isinstance(body, dict):
            own: dict = {}
            for sub, settings in body.items():
                named, more = _named(sub, settings)
                own |= named
                odd += [f"{section}.{m}" for m in more]
            branches[section] = own
        elif isinstance(body, dict):
            named, more = _named(section, body)
            values |= named
            odd += more
        else:
            named, more = _named("pipeline", {section: body})
            values |= named
            odd += more
    return Config(**values | {k: v for k, v in given.items() if v is not None}, branches=branches), odd


def dump(values: dict[str, dict]) -> str:
    """TOML of sections of plain values; truth values before numbers."""

    def one(v) -> str:
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, int | float):
            return repr(v)
        if isinstance(v, list | tuple):
            return "[" + ", ".join(one(x) for x in v) + "]"
        return '"' + str(v).replace("\\", "\\\\").replace('"', '\\"') + '"'

    return "\n".join(f"[{s}]\n" + "".join(f"{k} = {one(v)}\n" for k, v in body.items() if v is not None) for s, body in values.items())


def skipped(stage: str, cfg: Config) -> bool:
    if stage in MANDATORY:
        return False
    if stage in ("dewarp", "enhance", "normalize") and not getattr(cfg, stage):
        return True
    return stage in cfg.skip or stage in PROFILES.get(cfg.profile, ()) or (stage == "lens_correct" and cfg.lens_k1 == 0 and cfg.lens_k2 == 0)


def stage_hash(stage: str, cfg: Config, upstream: str = "") -> str:
    """Hash of what a stage reads and of the stage before it, so a change travels down every branch."""
    pairs = [f"{k}={getattr(cfg, k)!r}" for k in sorted(READS.get(stage, ()))]
    return hashlib.sha256("|".join([*pairs, upstream]).encode()).hexdigest()[:16]


def parse_stages(spec: str) -> list[int]:
    """Numbers of a specification such as 0,2-4."""
    out: set[int] = set()
    for part in spec.split(","):
        lo, dash, hi = part.strip().partition("-")
        if not lo.isdigit() or (dash and not hi.isdigit()):
            raise ValueError(f"not a stage or a range of stages: {part!r}")
        if dash and int(hi) < int(lo):
            raise ValueError(f"range runs backwards: {part!r}")
        out.update(range(int(lo), int(hi or lo) + 1))
    return sorted(out)
