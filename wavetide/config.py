"""Parameters of the event-pair analysis."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class PhaseSpec:
    """Geometry of one phase's windows, in samples where not said otherwise."""

    phase: str
    channels: tuple[int, ...]
    before_s: float  # of the pick, in the cut window
    after_s: float
    data_npts: int
    temp_npts: int
    temp_start: int
    shift_s: float  # from the window's start to the template's, negative
    dt_limit: float

    @property
    def n_lags(self) -> int:
        return self.data_npts - self.temp_npts


@dataclass(frozen=True)
class Config:
    """Defaults are the documented ones of the analysis; times in seconds, distances in km."""

    samp_rate: float = 1000.0
    freq_band: tuple[float | None, float | None] = (1.0, 16.0)
    chn_p: tuple[int, ...] = (2,)
    chn_s: tuple[int, ...] = (0, 1)
    win_temp_p: tuple[float, float] = (0.2, 1.0)
    win_temp_s: tuple[float, float] = (0.2, 2.5)
    dt_thres: tuple[float, float] = (0.5, 0.8)
    cc_thres: float | None = 0.3
    scc_thres: float | None = 7.0
    peak_separation: float = 0.03
    loc_dev: float = 3.0
    dep_dev: float = 4.0
    dist_thres: float = 100.0
    min_dist: float = 1.5
    num_sta: int = 6
    max_nbr: int = 2000
    temp_mag: float = 0.0
    temp_sta: int = 6
    cal_win_days: float = 730.0
    warm_up_s: float = 20.0

    def phases(self) -> dict[str, PhaseSpec]:
        """Cut windows reach ``dt_thres`` beyond the template on each side."""
        out = {}
        for phase, channels, (before, after), limit in (("P", self.chn_p, self.win_temp_p, self.dt_thres[0]), ("S", self.chn_s, self.win_temp_s, self.dt_thres[1])):
            samples = lambda s: int(round(s * self.samp_rate))
            out[phase] = PhaseSpec(
                phase, channels, before + limit, after + limit, samples(before + after + 2 * limit), samples(before + after), samples(limit), -limit, limit
            )
        return out

    def but(self, **changes) -> Config:
        return replace(self, **changes)
