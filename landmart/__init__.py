"""Daily land-parcel and ownership snapshots as Spark DataFrame jobs."""
