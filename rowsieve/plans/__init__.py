"""Contracts, their execution, layered datasets and the comparison job."""
