"""Price-list wording of the SKU patterns, written out: kind | component | first pattern | last pattern.

Fixed values. The fixture's price list and the oracle use this text, not the tables that
`plans.skumap` builds its patterns from, so a fault there shows.
"""

from __future__ import annotations

WORDING = """
cpu | e2-predefined | E2 Instance Core running in% |
cpu | e2-custom | E2 Instance Core running in% |
cpu | e2-cud-1y | Commitment v1: E2 Cpu in% | %for 1 Year
cpu | e2-cud-3y | Commitment v1: E2 Cpu in% | %for 3 Year
cpu | a2-predefined | A2 Instance Core running in% |
cpu | a2-cud-1y | Commitment v1: A2 Cpu in% | %for 1 Year
cpu | a2-cud-3y | Commitment v1: A2 Cpu in% | %for 3 Year
cpu | a3-predefined | A3 Instance Core running in% |
cpu | a3-cud-1y | Commitment v1: A3 Cpu in% | %for 1 Year
cpu | a3-cud-3y | Commitment v1: A3 Cpu in% | %for 3 Years
cpu | g2-predefined | G2 Instance Core running in% |
cpu | g2-custom | G2 Custom Instance Core running in% |
cpu | g2-cud-1y | Commitment v1: G2 Cpu in% | %for 1 Year
cpu | g2-cud-3y | Commitment v1: G2 Cpu in% | %for 3 Years
cpu | n1-predefined | N1 Predefined Instance Core running in% |
cpu | n1-custom | Custom Instance Core running in% |
cpu | n1-cud-1y | Commitment v1: Cpu in% | %for 1 Year
cpu | n1-cud-3y | Commitment v1: Cpu in% | %for 3 Year
cpu | n2-predefined | N2 Instance Core running in% |
cpu | n2-custom | N2 Custom Instance Core running in% |
cpu | n2-cud-1y | Commitment v1: N2 Cpu in% | %for 1 Year
cpu | n2-cud-3y | Commitment v1: N2 Cpu in% | %for 3 Year
cpu | n2d-predefined | N2D AMD Instance Core running in% |
cpu | n2d-custom | N2D AMD Custom Instance Core running in% |
cpu | n2d-cud-1y | Commitment v1: N2D AMD Cpu in% | %for 1 Year
cpu | n2d-cud-3y | Commitment v1: N2D AMD Cpu in% | %for 3 Year
cpu | c2-predefined | Compute optimized Core running in% |
cpu | c2-cud-1y | Commitment: Compute optimized Core running in% | %for 1 Year
cpu | c2-cud-3y | Commitment: Compute optimized Core running in% | %for 3 Year
cpu | c3-predefined | C3 Instance Core running in% |
cpu | c3-cud-1y | Commitment v1: C3 Cpu in% | %for 1 Year
cpu | c3-cud-3y | Commitment v1: C3 Cpu in% | %for 3 Years
cpu | c3d-predefined | C3D Instance Core running in% |
cpu | c3d-cud-1y | Commitment v1: C3D Cpu in% | %for 1 Year
cpu | c3d-cud-3y | Commitment v1: C3D Cpu in% | %for 3 Years
cpu | g4-predefined | G4 Instance Core running in% |
cpu | g4-cud-1y | Commitment v1: G4 Cpu in% | %for 1 Year
cpu | g4-cud-3y | Commitment v1: G4 Cpu in% | %for 3 Years
cpu | c4-predefined | C4 Instance Core running in% |
cpu | c4-cud-1y | Commitment v1: C4 Cpu in% | %for 1 Year
cpu | c4-cud-3y | Commitment v1: C4 Cpu in% | %for 3 Years
cpu | c4d-predefined | C4D Instance Core running in% |
cpu | c4d-cud-1y | Commitment v1: C4D Cpu in% | %for 1 Year
cpu | c4d-cud-3y | Commitment v1: C4D Cpu in% | %for 3 Years
cpu | z3-predefined | Z3 Instance Core running in% |
cpu | z3-cud-1y | Commitment v1: Z3 Cpu in% | %for 1 Year
cpu | z3-cud-3y | Commitment v1: Z3 Cpu in% | %for 3 Years
ram | e2-predefined | E2 Instance Ram running in% |
ram | e2-custom | E2 Instance Ram running in% |
ram | e2-cud-1y | Commitment v1: E2 Ram in% | %for 1 Year
ram | e2-cud-3y | Commitment v1: E2 Ram in% | %for 3 Year
ram | a2-predefined | A2 Instance Ram running in% |
ram | a2-cud-1y | Commitment v1: A2 Ram in% | %for 1 Year
ram | a2-cud-3y | Commitment v1: A2 Ram in% | %for 3 Year
ram | a3-predefined | A3 Instance Ram running in% |
ram | a3-cud-1y | Commitment v1: A3 Ram in% | %for 1 Year
ram | a3-cud-3y | Commitment v1: A3 Ram in% | %for 3 Years
ram | g2-predefined | G2 Instance Ram running in% |
ram | g2-custom | G2 Custom Instance Ram running in% |
ram | g2-cud-1y | Commitment v1: G2 Ram in% | %for 1 Year
ram | g2-cud-3y | Commitment v1: G2 Ram in% | %for 3 Years
ram | n1-predefined | N1 Predefined Instance Ram running in% |
ram | n1-custom | Custom Instance Ram running in% |
ram | n1-cud-1y | Commitment v1: Ram in% | %for 1 Year
ram | n1-cud-3y | Commitment v1: Ram in% | %for 3 Year
ram | n2-predefined | N2 Instance Ram running in% |
ram | n2-custom | N2 Custom Instance Ram running in% |
ram | n2-cud-1y | Commitment v1: N2 Ram in% | %for 1 Year
ram | n2-cud-3y | Commitment v1: N2 Ram in% | %for 3 Year
ram | n2d-predefined | N2D AMD Instance Ram running in% |
ram | n2d-custom | N2D AMD Custom Instance Ram running in% |
ram | n2d-cud-1y | Commitment v1: N2D AMD Ram in% | %for 1 Year
ram | n2d-cud-3y | Commitment v1: N2D AMD Ram in% | %for 3 Year
ram | c2-predefined | Compute optimized Ram running in% |
ram | c2-cud-1y | Commitment: Compute optimized Ram running in% | %for 1 Year
ram | c2-cud-3y | Commitment: Compute optimized Ram running in% | %for 3 Year
ram | c3-predefined | C3 Instance Ram running in% |
ram | c3-cud-1y | Commitment v1: C3 Ram in% | %for 1 Year
ram | c3-cud-3y | Commitment v1: C3 Ram in% | %for 3 Years
ram | c3d-predefined | C3D Instance Ram running in% |
ram | c3d-cud-1y | Commitment v1: C3D Ram in% | %for 1 Year
ram | c3d-cud-3y | Commitment v1: C3D Ram in% | %for 3 Years
ram | g4-predefined | G4 Instance Ram running in% |
ram | g4-cud-1y | Commitment v1: G4 Ram in% | %for 1 Year
ram | g4-cud-3y | Commitment v1: G4 Ram in% | %for 3 Years
ram | c4-predefined | C4 Instance Ram running in% |
ram | c4-cud-1y | Commitment v1: C4 Ram in% | %for 1 Year
ram | c4-cud-3y | Commitment v1: C4 Ram in% | %for 3 Years
ram | c4d-predefined | C4D Instance Ram running in% |
ram | c4d-cud-1y | Commitment v1: C4D Ram in% | %for 1 Year
ram | c4d-cud-3y | Commitment v1: C4D Ram in% | %for 3 Years
ram | z3-predefined | Z3 Instance Ram running in% |
ram | z3-cud-1y | Commitment v1: Z3 Ram in% | %for 1 Year
ram | z3-cud-3y | Commitment v1: Z3 Ram in% | %for 3 Years
gpu | nvidia-tesla-a100 | Nvidia Tesla A100 GPU running in% |
gpu | nvidia-tesla-a100-cud-1y | Commitment v1: Nvidia Tesla A100 GPU running in% | %for 1 Year
gpu | nvidia-tesla-a100-cud-3y | Commitment v1: Nvidia Tesla A100 GPU running in% | %for 3 Year
gpu | nvidia-tesla-t4 | Nvidia Tesla T4 GPU running in% |
gpu | nvidia-tesla-t4-cud-1y | Commitment v1: Nvidia Tesla T4 GPU running in% | %for 1 Year
gpu | nvidia-tesla-t4-cud-3y | Commitment v1: Nvidia Tesla T4 GPU running in% | %for 3 Year
gpu | nvidia-l4 | Nvidia L4 GPU running in% |
gpu | nvidia-l4-cud-1y | Commitment v1: Nvidia L4 GPU running in% | %for 1 Year
gpu | nvidia-l4-cud-3y | Commitment v1: Nvidia L4 GPU running in% | %for 3 Years
gpu | nvidia-h100-80gb | Nvidia H100 80GB GPU running in% |
gpu | nvidia-h100-80gb-cud-1y | Commitment v1: Nvidia H100 80GB GPU running in% | %for 1 Year
gpu | nvidia-h100-80gb-cud-3y | Commitment v1: Nvidia H100 80GB GPU running in% | %for 3 Years
gpu | nvidia-h100-mega-80gb | Reserved Nvidia H100 80GB Mega GPU in% |
gpu | nvidia-h100-mega-80gb-cud-1y | Commitment v1: Nvidia H100 80GB Mega GPU running in% | %for 1 Year
gpu | nvidia-h100-mega-80gb-cud-3y | Commitment v1: Nvidia H100 80GB Mega GPU running in% | %for 3 Years
gpu | nvidia-rtx-pro-6000 | RTX 6000 96GB running in% |
gpu | nvidia-rtx-pro-6000-cud-1y | Commitment v1: RTX 6000 96GB running in% | %for 1 Year
gpu | nvidia-rtx-pro-6000-cud-3y | Commitment v1: RTX 6000 96GB running in% | %for 3 Years
gpu | nvidia-b200 | A4 Nvidia B200 (1 gpu slice) running in% |
gpu | nvidia-b200-cud-1y | Commitment v1: A4 Nvidia B200 (1 gpu slice) in% | %for 1 Year
gpu | nvidia-b200-cud-3y | Commitment v1: A4 Nvidia B200 (1 gpu slice) in% | %for 3 Year%
disk | local-ssd | SSD backed Local Storage |
disk | local-ssd | SSD backed Local Storage in% |
disk | local-ssd-cud-1y | Commitment v1: Local SSD in% | %for 1 Year
disk | local-ssd-cud-3y | Commitment v1: Local SSD in% | %for 3 Year
disk | pd-ssd | SSD backed PD Capacity |
disk | pd-ssd | SSD backed PD Capacity in% |
disk | pd-balanced | Balanced PD Capacity |
disk | pd-balanced | Balanced PD Capacity in% |
disk | pd-standard | Storage PD Capacity |
disk | pd-standard | Storage PD Capacity in% |
disk | pd-custom | Efficient Storage PD Capacity in% |
nat | nat-data | NAT Gateway: Data processing charge in% |
"""


def wording_rows() -> list[tuple[str, str, str, str | None]]:
    out = []
    for text in WORDING.strip().splitlines():
        kind, component, first, *last = (t.strip() for t in text.split("|"))
        out.append((kind, component, first, (last[0] or None) if last else None))
    return out
