"""Plant specifications. All numbers here are fixed values of the modelled plant."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PVString:
    """One string of panels and its inverter."""

    name: str
    pmp_stc: float
    gamma_mp: float
    n_series: int
    n_parallel: int
    a: float = -3.56
    b: float = -0.0750
    d_t: float = 3.0
    eff_p: tuple[float, ...] = (0, 250, 400, 450, 500, 600, 650, 750, 825, 1000, 1200, 1600, 2000, 3000, 4000, 6000, 8000, 10000)
    eff_percent: tuple[float, ...] = (0, 85.5, 90.2, 90.9, 91.8, 92, 92.3, 94, 94.4, 94.8, 95.6, 96, 97.3, 97.7, 98, 98.1, 98.05, 98)

    @property
    def eff_max(self) -> float:
        return max(self.eff_percent)

    @property
    def p_max(self) -> float:
        return max(self.eff_p)


@dataclass(frozen=True)
class PVPlant:
    strings: tuple[PVString, ...] = (PVString("a", 165.0, -0.00478, 18, 2), PVString("b", 125.0, -0.0045, 6, 2))
    e_stc: float = 1000.0
    t_stc: float = 25.0
    length: float = 10.0
    width: float = 1.5
    thickness: float = 0.1
    conductivity: float = 350.0


@dataclass(frozen=True)
class WindTurbine:
    rated: float = 11.0
    cut_in: float = 3.5
    cut_out: float = 25.0
    speed: tuple[float, ...] = (3.5, 6, 8, 10, 10.5, 11, 12, 13, 13.4, 14, 16, 18, 20, 22, 24, 25)
    power: tuple[float, ...] = (0, 5, 8.5, 10.9, 11.2, 11.3, 11.2, 10.5, 10.5, 10, 8.8, 8.7, 8, 7.3, 6.6, 6.3)


PV = PVPlant()
WT = WindTurbine()
