"""Named relations: staging, star schema, marts, dashboard cards, quality suite and the late-delivery job."""
