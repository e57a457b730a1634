"""End-to-end jobs: named compositions of the operators, one job for all tenants."""
