"""roadcast.sources"""
