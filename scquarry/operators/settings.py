"""Checks of settings and of what users decided: plain values, no tables. Each gives the checked value or raises ValueError."""

from __future__ import annotations

import math
from collections.abc import Sequence

#: What a decision on quality control may be about, and what a regression may be on.
DECISIONS = ("remove_low_cell_samples", "keep_without_doubletfinder", "override_parameters", "accept_default_conflicts", "accept_qc_removal")
SCHEMES = ("feature", "count", "cell_cycle")
REDUCTIONS = ("auto", "pca", "harmony")
#: Shares at which a contamination review warns.
AMBIENT = {"mean_warning": 0.5, "median_warning": 0.5, "p95_warning": 0.8, "high_contamination": 0.5, "marker_retention_warning": 0.2}


def _number(v, low: float = 0.0, high: float = math.inf) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v) and low <= v <= high


def _said(d: dict) -> bool:
    """Whether a decision is a user's, in their own words."""
    return d.get("confirmed_by") == "user" and isinstance(d.get("user_statement"), str) and bool(d["user_statement"].strip())


def resolutions(values: Sequence) -> list[float]:
    """Two positive resolutions or more, each once, in order."""
    out = [float(v) for v in values if _number(v, math.ulp(0.0))]
    if len(out) != len(values) or len(out) < 2 or len(set(out)) != len(out):
        raise ValueError("resolutions must be two or more different positive numbers")
    return sorted(out)


def analysis_config(cfg: dict) -> dict:
    """Settings of a formal analysis: numbers in their ranges, known names, and no correction for biological groups."""
    out = dict(cfg)
    for f in ("seed", "nfeatures", "max_pcs"):
        if not _number(cfg.get(f), 0 if f == "seed" else 3) or cfg[f] != int(cfg[f]):
            raise ValueError(f"{f} must be a whole number in its range")
    if not _number(cfg.get("risk_correlation"), 0, 1):
        raise ValueError("risk_correlation must be a share")
    for f in ("pc_cumulative_variance", "pc_individual_variance", "pc_elbow_drop"):
        if not _number(cfg.get(f), 0, 100):
            raise ValueError(f"{f} must be a percentage")
    if not isinstance(cfg.get("assay"), str) or not cfg["assay"]:
        raise ValueError("assay must name one assay")
    out["sensitivity"] = ["count" if s == "rna_total" else s for s in cfg.get("sensitivity", ())]
    if not set(out["sensitivity"]) <= set(SCHEMES):
        raise ValueError("sensitivity names an unknown scheme")
    review = cfg.get("regression_review") or {}
    for f in ("cluster_eta_warning", "similar_ari", "similar_subspace", "association_tolerance"):
        if not _number(review.get(f), 0, 1):
            raise ValueError(f"regression_review.{f} must be a share")
    if not isinstance(review.get("auto_numeric"), bool) or not _number(review.get("comparison_resolution"), math.ulp(1.0)):
        raise ValueError("regression_review needs auto_numeric and a positive comparison_resolution")
    out["resolutions"] = resolutions(cfg.get("resolutions", ()))
    if cfg.get("cluster_reduction") not in REDUCTIONS:
        raise ValueError("cluster_reduction is unknown")
    decision = cfg.get("regression_decision")
    if decision is not None and not (_said(decision) and decision.get("scheme") in SCHEMES):
        raise ValueError("regression_decision must be a user's own, on a known scheme")
    harmony = cfg.get("harmony") or {}
    if not all(isinstance(harmony.get(f), bool) for f in ("enabled", "allow_sample")):
        raise ValueError("harmony.enabled and harmony.allow_sample must be true or false")
    if "group" in [harmony.get("batch_field"), *harmony.get("technical_fields", ())]:
        raise ValueError("the group is no batch")
    return out


def ambient_thresholds(overrides: dict | None = None) -> dict[str, float]:
    """The thresholds of a contamination review with overrides; all are shares."""
    out = {**AMBIENT, **(overrides or {})}
    for k in AMBIENT:
        if not _number(out[k], 0, 1):
            raise ValueError(f"{k} must be a share")
    return out


def qc_decision(decision: dict | None, samples: Sequence[str]) -> dict:
    """A user's decision on samples: literal, of a known type, on samples that exist, and of the types that what it does asks for."""
    if not decision:
        return {}
    d = dict(decision)
    if not _said(d):
        raise ValueError("a decision must be confirmed by the user in words")
    types = [d["decision_type"]] if isinstance(d.get("decision_type"), str) else list(d.get("decision_type") or ())
    if not types or d.get("affected_samples") is None:
        raise ValueError("a decision must say its types and the samples it is about")
    affected, removed, kept = (list(d.get(k) or ()) for k in ("affected_samples", "removed_samples", "kept_low_cell_samples"))
    named = removed + kept
    if not affected or len(set(affected)) < len(affected) or len(set(named)) < len(named) or not set(named + affected) <= set(samples) or not set(types) <= set(DECISIONS):
        raise ValueError("a decision names samples or types that are unknown or named twice")
    if named and not (set(named) <= set(affected) if "accept_qc_removal" in types else set(named) == set(affected)):
        raise ValueError("affected_samples must be the samples removed and kept, or include them where a loss is accepted")
    needed = {"remove_low_cell_samples": removed, "keep_without_doubletfinder": kept, "override_parameters": d.get("parameter_overrides"), "accept_qc_removal": d.get("accept_qc_removal")}
    for kind, given in needed.items():
        if given and kind not in types:
            raise ValueError(f"decision_type missing: {kind}")
    return {**d, "removed_samples": removed, "kept_low_cell_samples": kept}


def resolution_decision(d: dict) -> dict:
    """A user's choice of a resolution: literal and positive."""
    if not _said(d) or not _number(d.get("resolution"), math.ulp(0.0)):
        raise ValueError("a resolution must be positive and confirmed by the user in words")
    return d


def group_confirmation(d: dict, samples: Sequence[str]) -> dict[str, str]:
    """The groups that a user confirmed: one for each of the samples, or of the subset that the user selected, and for no other."""
    wanted = list(samples)
    if "selected_samples" in d:
        wanted = list(d["selected_samples"] or ())
        if not wanted or len(set(wanted)) < len(wanted) or not set(wanted) <= set(samples):
            raise ValueError("selected_samples must be some of the samples, each once")
    groups = d.get("groups")
    if not _said(d) or not isinstance(groups, dict) or set(groups) != set(wanted) or any(not isinstance(g, str) or not g.strip() for g in groups.values()):
        raise ValueError("a user must confirm a group for exactly the selected samples")
    return {s: groups[s] for s in wanted}
