"""What a user calls: marts, analyst questions, quality reports, load and rebuild jobs."""
