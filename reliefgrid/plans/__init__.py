"""Multi-round jobs: strip building, tile building, registration."""
