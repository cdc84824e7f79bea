"""roadcast.streaming"""
